import hashlib
import random

import numpy as np

from factdim.llm.window_dedup import from_planes, remove_windows, to_planes, window_hashes

SCHEMA = "doc_id long, text string, grp string, n_words string"


def brute(rows, size):
    """Removal by looking at every window of the corpus."""
    first: dict = {}
    for i, t in rows:
        if i is not None:
            w = t.encode().split()
            for p in range(len(w) - size + 1):
                key = tuple(w[p : p + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = t.encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if i is not None and first[tuple(w[p : p + size])] < i:
                gone[p : p + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    got = remove_windows(df, **options).collect()
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))  # maximal
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str)


def test_planes_round_trip():
    x = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)
    assert (from_planes(to_planes(x)) == x).all()
    assert len(from_planes(to_planes(x[:0]))) == 0


def test_windows_never_cross_texts():
    hashes, places, begins = window_hashes([b"a b c", b"", b"a b", b"a b c d", b" "], 3)
    assert begins.tolist() == [0, 3, 3, 5, 9, 9]
    assert places.tolist() == [0, 5, 6] and hashes[0] == hashes[1] != hashes[2]
    assert window_hashes([], 13)[0].size == 0
    assert window_hashes([b"x", b"y"], 13)[0].size == 0


def test_removal_equals_brute_force(spark):
    rng = random.Random(11)
    words = ["the", "The", "of", "é", "☃", "a.", "b", "c"]
    passage = [rng.choice(words) + str(k % 7) for k in range(40)]
    texts = ["", None, "  \n ", "short text", "x " * 60, "x " * 13, "x " * 12, " ".join(passage), "\t".join(passage)]
    for _ in range(80):
        text = rng.choices(words, k=rng.randint(0, 60))
        a = rng.randrange(len(passage))
        at = rng.randint(0, len(text))
        texts.append(" ".join(text[:at] + passage[a : a + rng.randint(4, 40)] + text[at:]))
    texts += [rng.choice(texts) for _ in range(20)]
    rng.shuffle(texts)
    rows = [*enumerate(texts), (3, texts[5]), (9, texts[9]), (9, texts[9]), (None, texts[12]), (None, texts[12]), (-4, texts[20])]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    expected = brute([(i, t or "") for i, t in rows], 13)
    assert any(r[2] for r in expected)
    for options in ({}, {"group_bytes": 500, "bucket_bytes": 300}, {"group_bytes": 1 << 22, "bucket_bytes": 100}):
        assert found(df, words=13, **options) == expected


def test_whitespace_is_ascii_only(spark):
    """No-break spaces and the separators 0x1c-0x1f belong to words."""
    text = "a b c\x1cd\x85 e"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert found(df, words=2) == brute([(1, text)], 2)
    assert found(df, words=2)[0][1] == 3


def test_large_groups_of_copies_and_a_very_long_text(spark):
    rng = random.Random(12)
    copy = " ".join(str(rng.randrange(1000)) for _ in range(40))
    long = " ".join(str(rng.randrange(10**6)) for _ in range(200_000))  # more than a megabyte
    rows = [(i, copy) for i in range(400)] + [(500, long), (501, "z " + long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1:3] for r in found(df, group_bytes=1000)}
    assert got[0] == (40, 0) and all(got[i] == (40, 40) for i in range(1, 400))
    assert got[500] == (200_000, 0) and got[501] == (200_001, 200_000)


def test_empty_table(spark):
    assert remove_windows(spark.createDataFrame([], "doc_id long, text string")).collect() == []
