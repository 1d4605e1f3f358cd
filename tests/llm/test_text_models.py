import math
import random
import zlib
from collections import Counter

import numpy as np

from factdim.llm.language_model import CLASSES, Parameters, Trainer, score_texts
from factdim.llm.toxicity import maximal_segments, toxicity, without_toxic


def brute_segments(values):
    """Maximal segments by definition: the best segment (shortest of equals), then both sides."""
    best = None
    for a in range(len(values)):
        for b in range(a, len(values)):
            s = sum(values[a : b + 1])
            if s > 1e-12 and (best is None or s > best[0] + 1e-9):
                best = (s, a, b)
    if best is None:
        return []
    s, a, b = best
    right = [(x + b + 1, y + b + 1, z) for x, y, z in brute_segments(values[b + 1 :])]
    return [*brute_segments(values[:a]), (a, b, s), *right]


def test_segments_equal_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        # unequal values, so that no two segments tie
        values = [rng.uniform(0.2, 3) if rng.random() < 0.4 else -0.5 for _ in range(rng.randint(0, 14))]
        places = [i for i, v in enumerate(values) if v > 0]
        got = maximal_segments(places, [values[i] for i in places], 0.5)
        want = brute_segments(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def documents(n=400):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeghiklmnoprstu", k=rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rng.choices(words, k=rng.randint(20, 80))
        for _ in range(4 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["Vile", "vileness,", "scumbag", "rotter"]))
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_finds_held_out_documents(spark):
    rows, labels = documents()
    extra = [(None, "w1 w2", "x"), (9000, "", "x"), (9001, None, "x"), (9002, "scumbag rotter vile " * 20, "x"), (3, rows[3][1], "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1), (1, None), (77777, 1)], "doc_id long, toxic int")
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 3 == 1)
        if r.held_out and r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    by_id = {r.doc_id: r for r in got}
    assert by_id[9002].predicted == 1 and by_id[9000].score == by_id[9001].score
    kept = without_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in got)


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity(docs, none).collect()] == [(0.0, 0)]
    assert toxicity(docs.limit(0), none).collect() == []


def test_language_model_figures_and_gain(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):  # two languages: the words before tell which
        words = [f"{'ab'[i % 2]}{rng.randint(0, 60)}{'xy'[i % 2]}" for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words), 1.0))
    rows += [(1000, "", 1.0), (1001, None, 1.0), (1002, "Unseen words here", 1.0), (None, "A1x", 1.0), (4, "a1x a1x", 1.0)]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string, score double")).collect()
    fold = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7
    tokens: dict = {}
    for i, t, _ in rows:
        tokens.setdefault(i, []).extend([*(t or "").encode().lower().split(), None])
    counts = Counter(w for i, ws in tokens.items() if fold(i) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    gain = 0.0
    assert len(got) == len(tokens)
    for r in got:
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.held_out == (fold(r.doc_id) == 2)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        gain += r.score - r.base_score if r.held_out else 0
    assert gain > 0


def test_language_model_without_documents(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_table_is_normalised_and_training_helps():
    rng = np.random.default_rng(0)
    noise = np.full(CLASSES, 1 / CLASSES)
    model = Parameters.start(noise)
    trainer = Trainer(model, noise)
    before = rng.integers(0, CLASSES, (2048, 2))
    target = before[:, 0]  # the next class repeats the last one
    row = before[:, 0] * (CLASSES + 1) + before[:, 1]
    start = model.table()[row, target].mean()
    for _ in range(200):
        trainer.step(before, target)
    table = model.table()
    assert np.allclose((10.0**table).sum(1), 1, atol=1e-3)
    assert table[row, target].mean() > start + 0.5


def test_different_texts_under_one_header_are_all_learned_from(spark):
    """Labels of documents that share most of their words, and a label of each kind on equal texts."""
    rng = random.Random(9)
    header = " ".join("h" + "".join(rng.choices("abcdefg", k=5)) for _ in range(200))
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        own = " ".join("".join(rng.choices("mnopqrst", k=6)) for _ in range(10))
        rows.append((i, f"{header} {own} {'vilewordone vilewordtwo vilewordsix' if toxic else ''}"))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (0, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity(docs, labels).collect()}
    assert found == dict(marks)
