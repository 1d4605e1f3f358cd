import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from factdim.llm.periodic_runs import octaves, periodic_runs, periodic_words, z_function


def brute_runs(w):
    """All runs by trying every period at every place."""
    n, runs = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                runs.append((i, j + q - i, q))
            i = max(j, i) + 1
    minimal = [r for r in runs if not any(s <= r[0] and s + m >= r[0] + r[1] and q < r[2] for s, m, q in runs)]
    return sorted(minimal, key=lambda r: (r[0], r[2]))


def planted(w, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n, out = h // 10, len(w), list(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    for i in range(a, n):
        out[i] = w[a + (i - a) % p]
    return out


def brute(rows, plant):
    out = []
    for i, t in rows:
        w = t.encode().split()
        w = planted(w, i) if plant else w
        runs = brute_runs(w)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(runs), *top, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in periodic_runs(df, **options).collect()), key=str)


def test_z_function():
    assert z_function([]) == []
    assert z_function([1, 1, 2, 1, 1]) == [5, 1, 0, 2, 1]


def test_octaves_cover_every_period():
    for n in (6, 15, 16, 100, 1000):
        periods = [p for o in octaves(n) for p in range(o.low, o.high)]
        assert periods == list(range(1, len(periods) + 1)) and (len(periods) >= n // 4)
    assert octaves(5) == []


def test_planting():
    w = [b"%d" % i for i in range(50)]
    for doc_id in range(200):
        assert periodic_words(w, doc_id) == planted(w, doc_id)
    assert periodic_words([], 3) == [] and periodic_words(w, None) == w


def texts(rng):
    out = ["", None, " \n", "a", "a a a a a", "a a a a a a", "a b " * 5, "x " * 300, "a b a a b a " * 30]
    for _ in range(150):
        alphabet = rng.choice(["ab", "abcde", [str(k) for k in range(400)]])
        text = list(rng.choices(alphabet, k=rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            cycle = rng.choices(alphabet, k=rng.randint(1, rng.choice([3, 9, 40])))
            times = rng.randint(1, 9) * len(cycle) + rng.randint(0, len(cycle))
            text += (cycle * 12)[:times]
            text += rng.choices(alphabet, k=rng.randint(0, 9))
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("plant", [False, True])
def test_runs_equal_brute_force(spark, plant):
    some = texts(random.Random(12))
    rows = [*enumerate(some), (7, some[9]), (7, some[9]), (7, some[7]), (None, some[8]), (None, some[8])]
    schema = "doc_id long, text string, digest string, period string, start int"
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], schema)
    expected = brute([(i, t or "") for i, t in rows], plant)
    assert sum(r[1] for r in expected) > 100
    assert found(df, plant=plant) == expected
    assert found(df, plant=plant, strip_words=20) == expected  # solved in many tasks


def test_very_long_text(spark):
    rng = random.Random(3)
    cycle = [str(rng.randrange(10**6)) for _ in range(20_000)]
    words = cycle[:777] + cycle * 8 + ["end"] * 9  # more than a megabyte
    df = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words))], "doc_id long, text string")
    for strip_words in (1 << 18, 30_000):
        for r in periodic_runs(df, strip_words=strip_words).collect():
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (2, 160_777, 9, 1, 9000)
            assert [tuple(x) for x in r.runs] == [(777, 160_000, 20_000), (160_777, 9, 1)]


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
