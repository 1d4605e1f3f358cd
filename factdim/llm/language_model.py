"""Scores of texts under a log-bilinear neural language model.

The model predicts the output class of the next word from the classes of the two words before: frequent
words are classes of their own, all others fall into classes by their ending, inside which a word is drawn
by its smoothed frequency.  The class scores are bilinear in learned vectors.  Training is noise-contrastive:
every task runs over its part of the training documents in numpy and the parameters are averaged.  Scoring
normalises exactly, by matrix products over all contexts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import byte_words, count_terms, fold, largest, settle, text_or_empty, texts_of

#: At most so many frequent words, of at most HEAD_BYTES bytes each, are broadcast with their figures.
HEAD_TERMS = 1 << 16
HEAD_BYTES = 48
#: Output classes: the end of a text, frequent words, endings.
WORD_CLASSES, ENDING_CLASSES = 159, 96
CLASSES = 1 + WORD_CLASSES + ENDING_CLASSES
#: Before the first word of a text.
START = CLASSES
WIDTH, CONTEXT, NOISE, BATCH = 16, 2, 32, 1024
TRAINING_ROUNDS = 2
#: AdaGrad: step width, and the sum of squared gradients to start from.
RATE, START_SQUARES = 0.1, 1e-6

_PUNCTUATION = b".,;:!?|()\"'"


def ending(word: bytes) -> bytes:
    return word.rstrip(_PUNCTUATION)[-2:]


@dataclass
class Vocabulary:
    """What all tasks know of the words: figures of the head, the class of an ending, totals."""

    index: dict[bytes, int]
    counts: np.ndarray  # of the head words
    word_class: np.ndarray  # class of each head word
    endings: dict[bytes, int]
    totals: np.ndarray  # ending classes: counts + words + 1
    tokens: int
    distinct: int
    end_count: int
    noise: np.ndarray = field(default_factory=lambda: np.full(CLASSES, 1 / CLASSES))

    def classes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Head index (-1 for other words) and class of every word."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        out = self.word_class[at] if len(self.word_class) else np.zeros(len(at), np.int64)
        for i in np.flatnonzero(at < 0):
            out[i] = self.endings.get(ending(words[i]), CLASSES - 1)
        return at, out


@dataclass
class Parameters:
    """Vectors of contexts and outputs, a matrix for each context place, output biases."""

    context: np.ndarray
    place: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray) -> Parameters:
        rng = np.random.default_rng(5)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        place = np.repeat(np.eye(WIDTH, dtype=np.float32)[None], CONTEXT, 0)
        return cls(small(CLASSES + 1, WIDTH), place, small(CLASSES, WIDTH), np.log(noise).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.place, self.output, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, values: np.ndarray) -> Parameters:
        out, at = [], 0
        for p in self.parts():
            out.append(values[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Parameters(*out)

    def table(self) -> np.ndarray:
        """log10 probability of every output after every pair of context classes."""
        after = [self.context @ m for m in self.place]
        both = (after[0][:, None] + after[1][None]).reshape(-1, WIDTH)
        out = np.empty((len(both), CLASSES), np.float32)
        for at in range(0, len(both), 4096):
            score = both[at : at + 4096] @ self.output.T + self.bias
            score -= score.max(1, keepdims=True)
            out[at : at + 4096] = score - np.log(np.exp(score).sum(1, keepdims=True))
        out /= np.float32(math.log(10))
        return out


def summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows of equal index added up, as a table of ``n`` rows."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(index.astype(np.int16), kind="stable")
    at = index[order]
    begins = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[begins]] = np.add.reduceat(rows[order], begins)
    return out


class Trainer:
    """Noise-contrastive training with AdaGrad steps, in place."""

    def __init__(self, model: Parameters, noise: np.ndarray, rate: float = RATE) -> None:
        self.model, self.noise, self.rate = model, noise, rate
        self.squares = [np.full_like(p, START_SQUARES) for p in model.parts()]
        self.rng = np.random.default_rng(11)
        self.log_noise = np.log(noise * NOISE).astype(np.float32)

    def step(self, before: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        drawn = self.rng.choice(CLASSES, NOISE, p=self.noise)
        vectors = [m.context[before[:, j]] for j in range(CONTEXT)]
        predicted = sum(v @ m.place[j] for j, v in enumerate(vectors))
        right = (predicted * m.output[target]).sum(1) + m.bias[target] - self.log_noise[target]
        wrong = predicted @ m.output[drawn].T + m.bias[drawn] - self.log_noise[drawn]
        d_right = (1 / (1 + np.exp(-np.clip(right, -30, 30))) - 1)[:, None] / n
        d_wrong = 1 / (1 + np.exp(-np.clip(wrong, -30, 30))) / n
        d_predicted = d_right * m.output[target] + d_wrong @ m.output[drawn]
        d_output = summed(target, d_right * predicted, CLASSES)
        np.add.at(d_output, drawn, d_wrong.T @ predicted)
        d_bias = np.bincount(target, d_right[:, 0], CLASSES).astype(np.float32)
        np.add.at(d_bias, drawn, d_wrong.sum(0))
        d_context = np.zeros_like(m.context)
        d_place = np.empty_like(m.place)
        for j in range(CONTEXT):
            d_place[j] = vectors[j].T @ d_predicted
            d_context += summed(before[:, j], d_predicted @ m.place[j].T, CLASSES + 1)
        for p, s, d in zip(m.parts(), self.squares, [d_context, d_place, d_output, d_bias], strict=True):
            s += d * d
            p -= self.rate * d / np.sqrt(s)


def _contexts(classes: np.ndarray) -> np.ndarray:
    """The two classes before each place of a text that starts with START, START."""
    padded = np.concatenate([np.full(CONTEXT, START), classes])
    return np.stack([padded[CONTEXT - 1 - j : len(padded) - 1 - j] for j in range(CONTEXT)], 1)


def learn_vocabulary(counts: DataFrame, documents: int) -> Vocabulary:
    """Collect the head, the endings and the totals from the word counts (term, n)."""
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    head = largest(counts.where(F.length("term") <= HEAD_BYTES), F.col("n"), HEAD_TERMS).collect()
    head.sort(key=lambda r: (-r.n, bytes(r.term)))
    own = {bytes(r.term): k for k, r in enumerate(head[:WORD_CLASSES], 1)}
    # at most 65 793 endings of two bytes or less
    found = counts.mapInArrow(_ending_counts(own), "term binary, n long, words long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words")
    ).collect()
    found.sort(key=lambda r: (-r.n, bytes(r.term)))
    endings = {bytes(r.term): 1 + WORD_CLASSES + k for k, r in enumerate(found[: ENDING_CLASSES - 1])}
    totals, mass = np.ones(CLASSES), np.full(CLASSES, 0.5)
    for r in found:
        k = endings.get(bytes(r.term), CLASSES - 1)
        totals[k] += r.n + r.words
        mass[k] += r.n
    for r in head[:WORD_CLASSES]:
        mass[own[bytes(r.term)]] += r.n
    mass[0] += documents
    word_class = [own.get(bytes(r.term)) or endings.get(ending(bytes(r.term)), CLASSES - 1) for r in head]
    return Vocabulary(
        {bytes(r.term): i for i, r in enumerate(head)},
        np.array([r.n for r in head], np.int64),
        np.array(word_class, np.int64),
        endings,
        totals,
        (total.n or 0) + documents,
        total.v + (1 if documents else 0),
        documents,
        mass / mass.sum(),
    )


def _ending_counts(own: dict[bytes, int]):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, words = Counter(), Counter()
        for batch in batches:
            for term, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if term not in own:
                    n[ending(term)] += times
                    words[ending(term)] += 1
        found = list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array([n[e] for e in found], pa.int64()), pa.array([words[e] for e in found], pa.int64())],
            ["term", "n", "words"],
        )

    return count


def train(training: DataFrame, vocabulary: Vocabulary) -> Parameters:
    """Noise-contrastive training over all texts, a part of them in each round.

    Every task starts from the common parameters and steps through its texts; the results are averaged by
    the number of tokens.  What comes back is as large as the model, whatever the texts.
    """
    spark = training.sparkSession
    model = Parameters.start(vocabulary.noise)
    words = spark.sparkContext.broadcast(vocabulary)
    for turn in range(TRAINING_ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = words.value
            local = shared.value.filled(shared.value.flat())
            trainer, seen = Trainer(local, known.noise), 0
            before, target, waiting = [], [], 0
            for text in texts_of(batches):
                classes = np.append(known.classes(byte_words(text))[1], 0)
                before.append(_contexts(classes))
                target.append(classes)
                waiting += len(classes)
                if waiting >= 16 * BATCH:
                    _steps(trainer, np.concatenate(before), np.concatenate(target))
                    before, target, seen, waiting = [], [], seen + waiting, 0
            if waiting:
                _steps(trainer, np.concatenate(before), np.concatenate(target))
            seen += waiting
            if seen:
                values = local.flat().astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), seen))],
                    ["i", "value", "seen"],
                )

        part = training.where(F.pmod(F.xxhash64("text"), F.lit(TRAINING_ROUNDS)) == turn)
        averaged = (
            part.mapInArrow(run, "i long, value double, seen long")
            .groupBy("i")
            .agg((F.sum("value") / F.sum("seen")).alias("value"))
            .collect()
        )
        if averaged:
            values = np.empty(len(averaged))
            values[[r.i for r in averaged]] = [r.value for r in averaged]
            model = model.filled(values)
    return model


def _steps(trainer: Trainer, before: np.ndarray, target: np.ndarray) -> None:
    order = trainer.rng.permutation(len(target))
    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        trainer.step(before[rows], target[rows])


_tables: dict[bytes, np.ndarray] = {}


def _table(model: Parameters) -> np.ndarray:
    """The model's probabilities, made once a worker."""
    key = model.flat().tobytes()
    if key not in _tables:
        _tables.clear()
        _tables[key] = model.table()
    return _tables[key]


def score_texts(docs: DataFrame, held_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """Log10 probability of every text under the model and under smoothed word frequencies.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  Learns from the
    documents whose crc32(doc_id as text) modulo ``held_out[0]`` is not ``held_out[1]``.  Tokens are the
    words (A-Z lowered, split at ASCII white space) and one end of text.  A null or empty text is the end
    alone; a null doc_id counts as the empty text in the fold.  Rows that share a doc_id are parts of one
    document: their figures are summed into one row.  Without training documents every token has
    frequency 0.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", held_out[0]) == held_out[1]).alias("held_out"), text_or_empty().alias("text")
    )
    training = texts.where(~F.col("held_out")).select("text")
    counts = settle(
        training.mapInArrow(lambda batches: count_terms(texts_of(batches), byte_words, pa.binary()), "term binary, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n")),
        "word-counts",
    )
    vocabulary = learn_vocabulary(counts, training.count())
    model = train(training, vocabulary)
    words, shared = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = words.value, _table(shared.value)
        frequency = np.log10(known.counts + 1.0)
        within = np.where(known.word_class > WORD_CLASSES, frequency - np.log10(known.totals[known.word_class]), 0.0)
        end_count = known.end_count
        total = math.log10(known.tokens + known.distinct + 1)
        for batch in batches:
            rows: list[tuple] = []
            rare, numbers, ends = [], [], [0]
            for text in batch.column(2):
                spelt = byte_words(text.as_py())
                at, classes = known.classes(spelt)
                classes = np.append(classes, 0)
                before = _contexts(classes)
                own = table[before[:, 0] * (CLASSES + 1) + before[:, 1], classes].sum(dtype=np.float64)
                head, tail = at[at >= 0], np.flatnonzero(at < 0)
                own += within[head].sum() - np.log10(known.totals[classes[tail]]).sum()
                base = frequency[head].sum() + math.log10(end_count + 1) - len(classes) * total
                rows.append((len(classes), len(head) + (end_count > 0), base, own))
                for term, n in Counter([spelt[i] for i in tail]).items():
                    rare.append(term)
                    numbers.append(n)
                ends.append(len(rare))
            offsets = pa.array(ends, pa.int32())
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                    pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary())),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int64())),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "terms", "numbers"],
            )

    figures = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    parts = settle(texts.mapInArrow(score, f"{figures}, terms array<binary>, numbers array<long>"), "text-scores")
    found = F.col("times") * F.log10(F.col("n") + 1.0)
    rare = (
        parts.select("doc_id", "held_out", F.explode(F.arrays_zip("terms", "numbers")).alias("t"))
        .select("doc_id", "held_out", F.col("t.terms").alias("term"), F.col("t.numbers").alias("times"))
        .join(counts, "term")
        .select(
            "doc_id",
            "held_out",
            F.lit(0).cast("long").alias("n_tokens"),
            F.col("times").alias("n_known"),
            found.alias("base_score"),
            found.alias("score"),
        )
    )
    return (
        parts.drop("terms", "numbers")
        .unionByName(rare)
        .groupBy("doc_id", "held_out")
        .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score"
        )
    )
