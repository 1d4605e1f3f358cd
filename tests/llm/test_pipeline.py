import random

import duckdb
import pytest

import corpus_pipeline
from factdim.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORDS = "river stone lamp cloud paper engine garden window letter mountain".split()


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.settle(stage(spark, docs, FOLDER), name)
        seen[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    before, after = seen["minhash_near_dedup"]
    assert after.count() < before.count()
    assert after.exceptAll(before).count() == 0
    before, after = seen["suffix_array_dedup"]
    assert after.count() == before.count()
    assert all(a.n_chars == len(a.text) for a in after.collect())
    before, pieces = seen["best_fit_packing"]
    assert pieces.where("piece = 0").count() == before.count()


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows, shared ids, a long text, clashing names: each row keeps its own columns."""
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(n))
    same, passage, long = words(60), words(40), words(120_000)
    rows = [
        (1, same, "s1"), (1, same, "s1"), (1, same, "s0"),  # repeated rows, one of another source
        (2, words(50), "s1"), (2, words(55), "s2"),  # one id, two texts
        (3, same, "s2"),  # a copy of 1
        (4, passage + " " + words(200), "s1"), (5, words(200) + " " + passage, "s2"),
        (6, long, "s2"), (7, "", "s1"), (8, None, "s1"), (9, "", None),
        (None, words(30), "n1"), (None, words(31), "n2"), (None, words(32), "n3"), (None, None, "n4"), (None, None, "n4"),
    ]
    clash = ["_text", "_id", "_copy", "_mark", "_size", "_own", "_number", "_words", "kept", "about", "row", "digest", "grp"]
    schema = "doc_id long, text string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in clash)
    full = [(i, t, s, len(t or ""), *[f"{s}.{len(t or '')}.{c}" for c in clash]) for i, t, s in rows]
    docs = spark.createDataFrame(full, schema)

    stages = dict(corpus_pipeline.STAGES)
    near = corpus_pipeline.settle(stages["minhash_near_dedup"](spark, docs, FOLDER), "near")
    want = [r for r in full if not (r[0] == 3 or r[:3] == (1, same, "s1"))][:-1]
    assert sorted(map(repr, map(tuple, near.collect()))) == sorted(map(repr, want))

    cut = corpus_pipeline.settle(stages["suffix_array_dedup"](spark, near, FOLDER), "cut")
    assert cut.schema.names == docs.schema.names
    whole = {(r[0], r[4]): r for r in want}
    got = {(r.doc_id, r[4]): tuple(r) for r in cut.collect()}
    assert got.keys() == whole.keys()
    for key, r in got.items():
        assert r[2] == whole[key][2] and r[3] == len(r[1]) and r[4:] == whole[key][4:]
        if key[0] != 5:
            assert r[1] == (whole[key][1] or "")
    assert sum(passage in r[1] for r in got.values()) == 1

    mixed = stages["mix_sources"](spark, cut, FOLDER)
    assert mixed.schema.names == docs.schema.names
    owner = {r[4:]: r for r in got.values()}
    for r in map(tuple, mixed.collect()):
        assert r[0] == owner[r[4:]][0] and r[2] == owner[r[4:]][2] and r[3] == len(r[1])
        assert set(r[1].split()) <= set(owner[r[4:]][1].split())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    frame = want.fetchall()
    place = [[d[0] for d in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == columns
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    assert rows == sorted(repr(tuple(r[i] for i in place)) for r in frame)
