import random
from collections import defaultdict

from factdim.llm.near_dup import chunk_keys, near_duplicates
from factdim.llm.shingles import shingle_sets


def shingles(text, k=5):
    w = text.encode().lower().split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(rows):
    sets = {i: shingles(t or "") for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base[:]
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_sets_are_those_of_word_tuples():
    texts = ["", "  a b ", "A b", "a  b\tc d e f a b c d e", "x" * 50, "é É a b c d"]
    hashes, begins = shingle_sets([t.encode() for t in texts])
    assert [b - a for a, b in zip(begins, begins[1:], strict=False)] == [len(shingles(t)) for t in texts]
    assert hashes[begins[1]] == hashes[begins[2]]


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    texts = ["", None, "a b", "A  b", "a b c", "one two three four five"]
    for length, edits in ((40, 1), (60, 2), (120, 3), (120, 5), (30, 1)):
        base = rng.choices(words, k=length)
        texts += near_copies(rng, base, 14, edits) + [" ".join(base)] * 3
    shared = rng.choices(words, k=50)
    texts += [" ".join(shared + rng.choices(words, k=30)) for _ in range(12)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 7) for i, t in [*rows, (None, texts[3]), (None, "a b")]], "doc_id long, text string, label int")
    got = near_duplicates(df).collect()
    want = components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_pairs_within_the_distance_share_a_key():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 2**16, 64).astype(np.uint16)
        b = a.copy()
        b[rng.choice(64, 31, replace=False)] ^= 1
        keys = chunk_keys(np.stack([a, b]))
        assert set(keys[0]) & set(keys[1])


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_many_members_of_one_group(spark):
    rng = random.Random(8)
    base = [f"q{i}" for i in range(60)]
    texts = near_copies(rng, base, 120, 3)
    counts = defaultdict(int)
    for r in near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        counts[r.component_id] += 1
    want = defaultdict(int)
    for _, c in components(list(enumerate(texts))).values():
        want[c] += 1
    assert counts == want
