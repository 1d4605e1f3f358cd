"""Toxic passages by maximum-scoring segments over token log-odds.

Terms (words, and the first letters of longer words) get the log-odds of occurring in documents labelled
toxic, smoothed by a Dirichlet prior; those that stand out score their log-odds, every other word costs a
little.  A linear-time scan finds all maximal segments of a document, and extreme-value statistics tell
which could not come from clean text of that length.  Their summed evidence is calibrated on the labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import first_by_hash, fold, ids_and_texts, largest, settle, text_or_empty
from factdim.llm.shingles import mix64, shingle_sets

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
PREFIX = 5
LONG_TEXT = 1 << 20

#: At most so many labelled documents are learned from, those first by hash of their id.
TRAINING_DOCUMENTS = 200_000
#: Dirichlet prior of a term in either class.  A term stands out from a z-score of MIN_Z on if its log-odds,
#: less two standard deviations, are at least MIN_ODDS: frequent words of long documents fail this.
PRIOR, MIN_Z, MIN_ODDS = 0.5, 3.0, 1.0
#: At most so many terms, those with the largest z-scores, form the model.
MODEL_TERMS = 20_000
#: Cost of a word that does not stand out.
NEUTRAL = 0.25


@dataclass(frozen=True)
class Model:
    """Scores of terms, the decay of chance scores, and the logistic calibration."""

    scores: dict[str, float]
    decay: float
    intercept: float = 0.0
    slope: float = 0.0

    def hits(self, text: str) -> tuple[list[int], list[float], int]:
        """Places and scores of the words that stand out, and the number of words."""
        places, values, n = [], [], 0
        scores = self.scores
        for words in split_words(text):
            for i, found in enumerate(map(scores.get, words), n):
                if found is not None:
                    places.append(i)
                    values.append(found)
                else:
                    prefix = scores.get(words[i - n][:PREFIX] + "-")
                    if prefix is not None:
                        places.append(i)
                        values.append(prefix)
            n += len(words)
        return places, values, n

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], float]:
        """Significant segments (first word, last word, evidence), and the evidence of all together.

        A segment of score S is met by chance n * exp(-decay * S) times in n words; its evidence is the
        logarithm of the inverse, and segments expected once or more do not count.
        """
        places, values, n = self.hits(text)
        chance = math.log(max(n, 1))
        found = [(a, b, self.decay * s - chance) for a, b, s in maximal_segments(places, values, NEUTRAL)]
        found = [f for f in found if f[2] > 0]
        return found, sum(f[2] for f in found)

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-(self.intercept + self.slope * math.log1p(evidence))))


def split_words(text: str) -> Iterator[list[str]]:
    """Lower-case words, all at once or a million at a time for a very long text."""
    text = text.lower()
    if len(text) <= LONG_TEXT:
        yield WORD.findall(text)
        return
    words = []
    for m in WORD.finditer(text):
        words.append(m.group())
        if len(words) == LONG_TEXT:
            yield words
            words = []
    yield words


def maximal_segments(places: Sequence[int], values: Sequence[float], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first place, last place, score) of a sequence given by its positive items.

    Items between cost ``neutral`` each.  Every candidate keeps the total before it and after it, and a link
    to the nearest candidate on the left that starts lower, so that the scan is linear.
    """
    first, last, before, after, link = [], [], [], [], []
    total, previous = 0.0, -1
    for place, value in zip(places, values, strict=True):
        total -= neutral * (place - previous - 1)
        a, low = place, total
        total += value
        previous = place
        j = len(first) - 1
        while True:
            while j >= 0 and before[j] >= low:
                j = link[j]
            if j < 0 or after[j] >= total:
                break
            a, low = first[j], before[j]  # grows to the left, over candidate j and all after it
            del first[j:], last[j:], before[j:], after[j:]
            j = link[j]
            del link[len(first) :]
        first.append(a)
        last.append(place)
        before.append(low)
        after.append(total)
        link.append(j)
    return [(a, b, r - s) for a, b, s, r in zip(first, last, before, after, strict=True)]


def chance_decay(scores: np.ndarray, rates: np.ndarray, neutral: float) -> float:
    """The positive root of sum(rate * exp(decay * score)) = 1 over the words of clean text."""
    rest = 1 - rates.sum()
    total = lambda x: float((rates * np.exp(x * scores)).sum() + rest * math.exp(-x * neutral))
    low, high = 1e-6, 1e-3
    while high < 50 and total(high) < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return low


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with a ridge that keeps them finite."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _terms(text: str) -> tuple[set[str], int]:
    """The terms of a text and its number of words."""
    terms: set[str] = set()
    n = 0
    for words in split_words(text):
        terms.update(words)
        n += len(words)
    return terms | {w[:PREFIX] + "-" for w in terms if len(w) > PREFIX}, n


def _sketch_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of the whole shingle set of each document: only documents of equal sets share it."""
    for ids, texts in ids_and_texts(batches):
        for at in range(0, len(ids), 200):
            part = [t.encode() for _, t in zip(range(200), texts)]  # noqa: B905
            shingles, begins = shingle_sets(part)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(shingles))])
            sketch = mix64(sums[begins[1:]] - sums[begins[:-1]] + np.diff(begins).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at : at + 200], pa.int64()), pa.array(sketch.view(np.int64))], ["doc_id", "sketch"]
            )


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class by term; the empty term counts documents, the term "-" their words."""
    toxic, clean = Counter(), Counter()

    def handed_on() -> Iterator[pa.RecordBatch]:
        terms = list(toxic.keys() | clean.keys())
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([toxic[t] for t in part], pa.int64()), pa.array([clean[t] for t in part], pa.int64())],
                ["term", "toxic", "clean"],
            )
        toxic.clear()
        clean.clear()

    for batch in batches:
        labels = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
        for label, text in zip(labels, batch.column(batch.schema.get_field_index("text")), strict=True):
            counts, (terms, n) = toxic if label else clean, _terms(text.as_py())
            counts.update(terms)
            counts[""] += 1
            counts["-"] += n
            if len(toxic) + len(clean) > 200_000:
                yield from handed_on()
    yield from handed_on()


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1)) -> Model | None:
    """Learn from the labelled documents whose crc32(doc_id) modulo ``held_out[0]`` is not ``held_out[1]``.

    At most ``TRAINING_DOCUMENTS`` are taken; of documents with equal shingle sets and the same label one counts.
    Returns None if there are no labelled documents of both classes.
    """
    spark = docs.sparkSession
    labelled = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", held_out[0]) != held_out[1]))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sample = first_by_hash(settle(labelled, "labelled"), "doc_id", TRAINING_DOCUMENTS)
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    # bounded by TRAINING_DOCUMENTS rows of two numbers
    sketched = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text")
    chosen = (
        sketched.mapInArrow(_sketch_batches, "doc_id long, sketch long")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("sketch", "toxic")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    chosen = settle(chosen.select("doc_id", "toxic").distinct(), "chosen")
    labelled = texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    counts = settle(
        labelled.mapInArrow(_count_batches, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "term-counts",
    )
    totals = {r.term: (r.toxic, r.clean) for r in counts.where(F.col("term").isin("", "-")).collect()}
    n_toxic, n_clean = totals.get("", (0, 0))
    if not n_toxic or not n_clean:
        return None
    a, b = F.col("toxic") + PRIOR, F.col("clean") + PRIOR
    odds = F.log(a / (n_toxic + 2 * PRIOR - a)) - F.log(b / (n_clean + 2 * PRIOR - b))
    spread = F.sqrt(1 / a + 1 / (n_toxic + 2 * PRIOR - a) + 1 / b + 1 / (n_clean + 2 * PRIOR - b))
    candidates = (
        counts.where(~F.col("term").isin("", "-") & (F.length("term") <= 64))
        .select("term", "clean", odds.alias("odds"), (odds / spread).alias("z"))
        .where((F.col("z") >= MIN_Z) & (F.col("odds") * (1 - 2 / F.col("z")) >= MIN_ODDS))
    )
    standing_out = largest(candidates, F.col("z"), MODEL_TERMS).collect()
    standing_out.sort(key=lambda r: (-r.z, r.term))
    if not standing_out:
        return Model({}, 1.0, *fit_logistic(np.zeros(2), np.array([0.0, 1.0]), np.array([n_clean, n_toxic], float)))
    scores = {r.term: r.odds for r in standing_out}
    rates = np.array([r.clean + PRIOR for r in standing_out]) / max(totals["-"][1], 1)
    rates *= min(1.0, 0.5 / rates.sum())
    model = Model(scores, chance_decay(np.array(list(scores.values())), rates, NEUTRAL))
    shared = spark.sparkContext.broadcast(model)

    def evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.passages(t.as_py())[1] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.round(np.log1p(np.array(found, float)), 2))], ["toxic", "x"]
            )

    # evidence is rounded to hundredths, so that a few hundred rows come back
    points = labelled.mapInArrow(evidence, "toxic int, x double").groupBy("toxic", "x").count().collect()
    x, y, w = (np.array(v, float) for v in zip(*[(p.x, p.toxic, p["count"]) for p in points], strict=True))
    return Model(scores, model.decay, *fit_logistic(x, y, w))


def toxicity(
    docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1), threshold: float = 0.7
) -> DataFrame:
    """Toxicity of every text: doc_id, held_out, score, predicted, passages.

    Learns from ``labels`` (doc_id, toxic) outside the held-out fold only (see :func:`train`).  score lies
    between 0 and 1; predicted is 1 from ``threshold`` on; passages are the significant segments as
    (first word, last word, evidence).  A null or empty text has no passages and gets the score of a text
    without evidence.  A null doc_id counts as the empty text in the fold.  Every row gives a row.  Without
    labelled documents of both classes all scores are 0.  Other columns are ignored; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, held_out))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())]))
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(2):
                found, evidence = model.passages(text.as_py()) if model else ([], 0.0)
                scores.append(model.score(evidence) if model else 0.0)
                passages.append([{"first": a, "last": b, "evidence": e} for a, b, e in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(passages, kind)],
                ["doc_id", "held_out", "score", "passages"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", held_out[0]) == held_out[1]).alias("held_out"), text_or_empty().alias("text")
    )
    return texts.mapInArrow(
        score, "doc_id long, held_out boolean, score double, passages array<struct<first: long, last: long, evidence: double>>"
    ).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def without_toxic(
    docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (3, 1), threshold: float = 0.7
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under ``threshold``; see :func:`toxicity`."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(train(docs, labels, held_out))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            clean = [not model or model.score(model.passages(t.as_py() or "")[1]) < threshold for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
