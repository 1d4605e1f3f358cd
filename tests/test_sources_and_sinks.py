"""Readers and writers on files."""

import datetime as dt
import json

import pytest
from helpers import rows, table

from factdim import schemas
from factdim.operators import avg_kills_per_game, bucketed_match_join, with_completion_day
from factdim.plans.inspect import count_nodes, exchanges
from factdim.session import bucket_join_session, scratch_dir
from factdim.sinks import tables
from factdim.sinks import compare_layouts, upsert, upsert_partitions, write_bucketed, write_period
from factdim.sources import decode_web_events, read_csv, read_table, read_web_events
from pyspark.sql import functions as F

LINES = [
    '{"ip": "1.2.3.4", "host": "h", "ts": 1697059200000, "path": "/home"}',
    "",
    '{"ip": "1.2.3.4", "host": "h", "ts": "1697059200001"}',
    '{"host": "h", "ts": 1, "path": "/no-ip"}',
    '{"ip": "1.2.3.4", "host": "h", "ts": "soon"}',
    "not json",
    "   ",
]
GOOD = [("1.2.3.4", "h", 1697059200000, "/home"), ("1.2.3.4", "h", 1697059200001, "")]


def test_web_events_from_files(spark, tmp_path):
    (tmp_path / "events.jsonl").write_text("\n".join(LINES))
    events = read_web_events(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in events.schema] == [(f.name, f.dataType) for f in schemas.WEB_EVENTS]
    assert rows(events) == GOOD
    rejected = read_web_events(spark, str(tmp_path), rejects=True)
    assert rejected.count() == 3
    assert [r._corrupt for r in rejected.collect() if r._corrupt] == ["not json"]
    assert read_web_events(spark, str(tmp_path), streaming=True).isStreaming


def test_web_events_from_messages(spark):
    messages = table(spark, "key binary, value binary", *[(b"k", line.encode()) for line in LINES])
    assert rows(decode_web_events(messages)) == GOOD
    assert decode_web_events(messages, rejects=True).count() == 5


def test_csv_with_schema_and_dirty_values(spark, tmp_path):
    (tmp_path / "details.csv").write_text("match_id,player_gamertag,player_total_kills\nm1,p,3\nm1,q,x\nm2,p,,extra\n")
    details = read_csv(spark, str(tmp_path), schemas.MATCH_DETAILS)
    assert rows(details) == [("m1", "p", "3"), ("m1", "q", "x"), ("m2", "p", None)]
    assert rows(avg_kills_per_game(details)) == [("p", 1.5), ("q", None)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "matches.csv").write_text("match_id,mapid,playlist_id,completion_date\nm1,1,p,2016-02-03 10:11:12\n")
    matches = with_completion_day(read_csv(spark, str(tmp_path / "m"), schemas.MATCHES))
    assert matches.first().completion_date == dt.datetime(2016, 2, 3)


def test_read_table_by_name_and_path(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, "a int, b int", (1, 2)).write.parquet(path)
    assert rows(read_table(spark, path).select("b")) == [(2,)]
    spark.read.parquet(path).createOrReplaceTempView("some_view")
    assert rows(read_table(spark, "some_view")) == [(1, 2)]


def test_write_period_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    write_period(table(spark, "k int, y int", (1, 1), (2, 1), (1, 2)), path, ["y"])
    write_period(table(spark, "k int, y int", (9, 2)), path, ["y"])
    write_period(table(spark, "k int, y int", (9, 2)), path, ["y"])
    assert rows(spark.read.parquet(path)) == [(1, 1), (2, 1), (9, 2)]


def test_upsert(spark, tmp_path):
    old = table(spark, "k int, m int, v string", (1, 1, "a"), (2, 1, "b"), (3, 2, "c"))
    new = table(spark, "k int, m int, v string", (2, 1, "B"), (4, 1, "D"))
    merged = [(1, 1, "a"), (2, 1, "B"), (3, 2, "c"), (4, 1, "D")]
    assert rows(upsert(old, new, ["k", "m"])) == merged
    path = str(tmp_path / "u")
    upsert_partitions(spark, path, old, ["k", "m"], ["m"])
    untouched = sorted(f.name for f in (tmp_path / "u" / "m=2").iterdir())
    for _ in range(2):
        upsert_partitions(spark, path, new, ["k", "m"], ["m"])
        assert rows(spark.read.parquet(path).select("k", "m", "v")) == merged
    assert sorted(f.name for f in (tmp_path / "u" / "m=2").iterdir()) == untouched
    upsert_partitions(spark, path, new, ["k", "m"], ["m"], [{"m": 1}])
    assert rows(spark.read.parquet(path).select("k", "m", "v")) == merged
    # an update outside the named partitions is refused and nothing is lost
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, table(spark, "k int, m int, v string", (9, 2, "z")), ["k", "m"], ["m"], [{"m": 1}])
    assert rows(spark.read.parquet(path).select("k", "m", "v")) == merged
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, new, ["k"], ["m"])


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    schema = "k int, m int, v string"
    path = str(tmp_path / "n")
    write_period(table(spark, schema, (1, None, "a"), (2, None, "b"), (3, 1, "c")), path, ["m"])
    upsert_partitions(spark, path, table(spark, schema, (4, None, "d"), (3, 1, "C"), (5, 2, "e")), ["k", "m"], ["m"])
    stored = spark.read.parquet(path).select("k", "m", "v").collect()
    assert sorted((r.k, r.m, r.v) for r in stored) == [(1, None, "a"), (2, None, "b"), (3, 1, "C"), (4, None, "d"), (5, 2, "e")]


def test_bucketed_join_is_shuffle_free(spark, tmp_path):
    def stored(name, schema, *data):
        write_bucketed(table(spark, schema, *data), name, 16, "match_id", str(tmp_path / name))

    stored("bd", "match_id string, player_gamertag string, kills int", ("m1", "p", 1), ("m1", "q", 2), ("m2", "p", 3))
    stored("bm", "match_id string, mapid string", ("m1", "a"), ("m2", "b"), ("m3", "c"))
    stored("be", "match_id string, player_gamertag string, medal_id string", ("m1", "p", "7"), ("m1", "p", "8"), ("m2", "q", "7"))
    reader = bucket_join_session(spark)
    tables = [reader.table(n) for n in ("bd", "bm", "be")]
    joined = bucketed_match_join(*tables)
    assert exchanges(joined) == 0 and count_nodes(joined, "SortMergeJoin") == 2
    assert rows(joined) == [("m1", "p", 1, "a", "7"), ("m1", "p", 1, "a", "8")]
    on_match = bucketed_match_join(*tables, player_keys=())
    assert exchanges(on_match) == 0 and count_nodes(on_match, "SortMergeJoin") == 2
    assert on_match.count() == 5
    # the caller's own session keeps its setting
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_several_files_per_bucket(spark, tmp_path):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    stored = write_bucketed(df, "spread", 4, "k", str(tmp_path / "spread"), files_per_bucket=4)
    assert rows(stored.agg(F.count("*"), F.count_distinct("id"))) == [(4000, 4000)]
    files = [f for f in (tmp_path / "spread").iterdir() if f.suffix == ".parquet"]
    assert 1 < len(files) <= 4


def test_layouts(spark, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 7)).alias("playlist_id"),
        (F.col("id") % 5).alias("mapid"),
        "id",
    )
    layouts = {"a": (["playlist_id"], ["mapid"]), "b": (["playlist_id", "mapid"], ["id"])}
    out = {r.layout: r for r in compare_layouts(df, layouts, str(tmp_path)).collect()}
    assert set(out) == {"a", "b"} and all(r.bytes > 0 for r in out.values())
    assert out["b"].files >= 35
    for name in layouts:
        assert spark.read.parquet(str(tmp_path / name)).count() == 20_000


def test_scratch_dir_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_sample_lines_are_json():
    assert json.loads(LINES[0])["ip"] == "1.2.3.4"
