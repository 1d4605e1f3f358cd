import math

import numpy as np
import pytest

from factdim.llm.bit_sliced import top_inner_products
from factdim.llm.nearest import nearest

SCHEMA = "vec_id long, embedding array<float>, score string"


def vectors(n=300, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.4, dim)], "x") for i in range(n)]
    rows += [(1000 + i, rows[40][1], "x") for i in range(40)]  # many equal vectors
    odd = [(2000, None, "x"), (2020, [1.0, None] * 4, "x"), (2040, [float("nan")] * 8, "x"), (2060, [math.inf] * 8, "x")]
    odd += [(2080, [], "x"), (None, [1.0] * 8, "x"), (2100, [0.0] * 8, "x"), (2120, [1.0, 2.0], "x"), (2121, [1.0, 3.0], "x")]
    return rows + odd + [rows[7], (60, [9.0] * 8, "x")]


def clean(rows, zero):
    by_id: dict = {}
    for i, v, _ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or (not zero and not any(v)):
            continue
        by_id[i] = min(by_id.get(i, v), v)
    return by_id


def test_top_k_equals_brute_force(spark):
    rows = vectors()
    got = top_inner_products(spark.createDataFrame(rows, SCHEMA), k=20, slab_rows=64, chunk_queries=4).collect()
    ints = {i: [math.floor(64 * x) for x in v] for i, v in clean(rows, zero=True).items()}
    want = set()
    for q in (i for i in ints if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        want |= {(q, k, i, -s) for k, (s, i) in enumerate(scores[:20], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert len(got) == len(want)


def test_top_k_of_very_large_components(spark):
    """No finite vector is dropped; what no long can hold is an error."""
    big = [(0, [1.0, 2.0]), (20, [2.0**24, 0.0]), (1, [1.0, 1.0]), (2, [1e8, -3.0]), (3, [-(2.0**24), 1e9]), (41, [0.25, 1e9])]
    rows = [(i, v, "x") for i, v in big]
    got = top_inner_products(spark.createDataFrame(rows, SCHEMA), k=20).collect()
    ints = {i: [math.floor(64 * x) for x in v] for i, v in big}
    fits = lambda s: -(2**63) <= s < 2**63
    want = set()
    for q in (0, 20):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)
        assert all(fits(s) for s, _ in scores)
        want |= {(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    for v in ([2.0**57, 1.0], [1e30, 0.0]):
        with pytest.raises(Exception, match="2\\*\\*62|exceeds a long"):
            top_inner_products(spark.createDataFrame([(0, v, "x"), (1, v, "x")], SCHEMA)).collect()


def test_nearest_visiting_everything_equals_brute_force(spark):
    rows = vectors()
    found = nearest(spark.createDataFrame(rows, SCHEMA), k=10, every=20, reach=1e9, slab_rows=64, slab_pairs=500).collect()
    usable = clean(rows, zero=False)
    want = {}
    for q in (i for i in usable if i % 20 == 0):
        near = sorted((math.dist(usable[q], v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
        want |= {(q, k): (i, d) for k, (d, i) in enumerate(near[:10], 1)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found}
    assert got.keys() == want.keys() and len(found) == len(want)
    for k, (i, d) in want.items():
        assert got[k][0] == i and math.isclose(got[k][1], d, rel_tol=1e-12, abs_tol=1e-300)


def test_small_tables_and_rare_lengths_give_all_neighbours(spark):
    """With the registered parameters: k neighbours each, and the exact ones where k hold the whole group."""
    rng = np.random.default_rng(6)
    for n, rest in ((3, 0), (8, 0), (20, 0), (8, 400)):
        rows = [(100 * i, rng.normal(0, 0.4, 8).tolist(), "x") for i in range(n)]
        rows += [(100_000 + i, rng.normal(0, 0.4, 16).tolist(), "x") for i in range(rest)]
        got = nearest(spark.createDataFrame(rows, SCHEMA), k=10, every=100).collect()
        for q, v, _ in rows[:n]:
            near = sorted((math.dist(v, w), i) for i, w, _ in rows[:n] if i != q)
            found = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
            assert len(found) == min(10, n - 1)
            assert n > 11 or found == [i for _, i in near]


def recall(df, got, every: int) -> float:
    rows = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    ids, matrix = np.array(list(rows)), np.stack(list(rows.values()))
    hits = total = 0
    for q in ids[ids % every == 0]:
        d = ((matrix - rows[q]) ** 2).sum(1)
        best = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        total += len(best)
        hits += len({r.vec_id for r in got if r.query_id == q} & set(best))
    return hits / total


@pytest.mark.parametrize(("folder", "every"), [("sf0.01", 10), ("sf0.1", 20)])
def test_recall(spark, folder, every):
    """With the registered parameters; ranks and distances are those of the vectors found."""
    df = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    got = nearest(df, k=10, every=every).collect()
    assert recall(df, got, every) >= 0.9
    rows = {r.vec_id: r.embedding for r in df.collect()}
    by_query = {}
    for r in got:
        assert math.isclose(r.score, math.dist(rows[r.query_id], rows[r.vec_id]), rel_tol=1e-9)
        by_query.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    for found in by_query.values():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [f[1:] for f in found] == sorted(f[1:] for f in found)


def test_recall_off_centre(spark):
    """Vectors far from the origin, and some very far ones, still spread over the cells."""
    rng = np.random.default_rng(8)
    rows = [(i, (50 + rng.normal(0, 0.3, 24)).tolist(), "x") for i in range(1500)]
    rows += [(5000 + i, (1e6 * rng.random(24)).tolist(), "x") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert recall(df, nearest(df, k=10, every=50).collect(), 50) >= 0.9


def test_copies_of_one_vector(spark):
    """A third of all rows alike: the smallest ids are the neighbours, for the copies too."""
    rng = np.random.default_rng(9)
    same = rng.normal(0, 0.4, 16).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(0, 0.4, 16).tolist(), "x") for i in range(600)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), k=10, every=100).collect()
    copies = [i for i in range(600) if i % 3 == 0]
    for q in (0, 300):
        found = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert found == [(n, i, 0.0) for n, i in enumerate([i for i in copies if i != q][:10], 1)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_inner_products(empty).collect() == []
    assert nearest(empty).collect() == []
