import hashlib
import random

import numpy as np

from factdim.llm.suffix_array import common_prefixes, two_stage_order
from factdim.llm.suffix_dedup import remove_repeats, whole_characters
from factdim.plans.inspect import executed_plan


def brute(rows, length):
    """Removal by looking at every string of the corpus."""
    first: dict = {}
    for i, t in rows:
        if i is not None:
            for p in range(len(t) - length + 1):
                s = t[p : p + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if i is not None and first[t[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_two_stage_order_sorts_suffixes():
    rng = random.Random(2)
    for _ in range(200):
        b = bytes(rng.choices(b"ab\x00c", k=rng.randint(0, 120)))
        text = np.frombuffer(b, np.uint8)
        wanted = np.array([rng.random() < 0.4 for _ in b], bool)
        for order, some in ((two_stage_order(text, 56), set(range(len(b)))), (two_stage_order(text, 56, wanted), set(np.flatnonzero(wanted)))):
            keys = [(b + bytes(99))[i : i + 50] for i in order]
            assert set(order) == some and len(order) == len(some)
            assert keys == sorted(keys)
            assert list(common_prefixes(text, order, 50)) == [x == y for x, y in zip(keys, keys[1:], strict=False)]


def test_removal_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["thé", "of", "and", "erin", "ou", "tion", "☃", "le"]
    passage = " ".join(rng.choices(words, k=40))
    texts = ["", None, "short", "x" * 500, "x" * 130, passage, passage, passage[:60]]
    for _ in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(3)]
        a = rng.randrange(len(passage))
        parts.insert(rng.randrange(3), passage[a : a + rng.randint(20, 120)])
        texts.append("".join(parts))
    rng.shuffle(texts)
    rows = [*enumerate(texts), (3, texts[5]), (9, texts[9]), (None, passage), (None, passage)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_bytes string")
    for group_bytes in (1 << 22, 2000):  # one group, and many
        got = remove_repeats(df, length=50, group_bytes=group_bytes).collect()
        found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)
        assert found == brute([(i, (t or "").encode()) for i, t in rows], 50)
    for r in remove_repeats(df, length=50, characters=True).collect():
        bytes(r.kept).decode()  # no character is cut in two


def test_a_copied_text_marks_only_itself(spark):
    """Of two texts under one id only the one that copies a smaller id goes; the other stays and is a source."""
    rng = random.Random(8)
    a, b = ("".join(rng.choices("abcdefgh ", k=300)) for _ in range(2))
    rows = [(2, a), (5, a), (5, b), (7, "x" + b[40:200]), (7, a), (None, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for case in (df.limit(3), df):
        texts = [(r.doc_id, r.text.encode()) for r in case.collect()]
        for group_bytes in (1 << 22, 300):
            got = remove_repeats(case, length=50, group_bytes=group_bytes).collect()
            found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str)
            assert found == brute(texts, 50)


def test_whole_characters():
    text = "aé☃".encode()
    gone = np.array([1, 1, 0, 1, 1, 1], bool)
    assert whole_characters(text, gone).tolist() == [True, False, False, True, True, True]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_are_shuffled_once(spark):
    """Columns that come along share the shuffle of the texts with all three steps that read them."""
    docs = [(i, f"{i} " + "passage that comes again " * 4, f"s{i}") for i in range(9)]
    for carry in ([], ["source"]):
        found = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string, source string"), carry=carry)
        assert sorted((r.doc_id, r.n_spans) for r in found.collect()) == [(i, int(i > 0)) for i in range(9)]
        ran = executed_plan(found).split("Initial Plan")[0]  # what ran, after adaptive changes
        assert ran.count("ReusedExchange") == 2, ran
