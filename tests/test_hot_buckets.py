"""A bucketed join in which one match holds a third of the rows."""

import statistics
import uuid

import pytest
from helpers import rows, table
from pyspark.sql import functions as F

from factdim.operators import bucketed_match_join, hot_match_join
from factdim.plans.inspect import count_nodes, exchanges, python_nodes
from factdim.session import bucket_join_session
from factdim.sinks import heavy_hitters, write_bucketed_hot

BUCKETS = 8


def match_tables(spark, n=12_000):
    """Details and medals of ``n`` players, a third of them in the match 'final', and a few without match."""
    number = F.col("id")
    match = F.when(number % 3 == 0, "final").when(number % 100 != 1, F.concat(F.lit("m"), number % 700))
    player = F.concat(F.lit("p"), number)
    details = spark.range(n).select(match.alias("match_id"), player.alias("player_gamertag"), number.cast("string").alias("player_total_kills"))
    earned = spark.range(n * 2).select((number % n).alias("id"), number.alias("medal"))
    earned = earned.select(match.alias("match_id"), player.alias("player_gamertag"), F.col("medal").cast("string").alias("medal_id"))
    names = details.select("match_id").where("match_id IS NOT NULL").distinct()
    return details, names.withColumn("mapid", F.length("match_id").cast("string")), earned


def stored(spark, tmp_path, share):
    details, matches, earned = match_tables(spark)
    hot = sorted({*heavy_hitters(details, "match_id", share), *heavy_hitters(earned, "match_id", share)})
    name = uuid.uuid4().hex
    reader = bucket_join_session(spark)
    parts = {}
    for label, df, spread in (("d", details, ["player_gamertag"]), ("m", matches, []), ("e", earned, ["player_gamertag"])):
        write_bucketed_hot(df, f"{label}_{name}", BUCKETS, "match_id", hot, spread, f"{tmp_path}/{label}")
        parts[label] = [reader.table(f"{label}_{name}_{part}") for part in ("cold", "hot")]
    return hot, parts, hot_match_join(*parts["d"], *parts["m"], *parts["e"])


def test_heavy_hitters(spark):
    details, _, _ = match_tables(spark)
    assert heavy_hitters(details, "match_id", 0.1) == ["final"]
    assert heavy_hitters(details.limit(0), "match_id") == []
    assert heavy_hitters(table(spark, "a int", (None,), (None,), (7,)), "a", 0.5) == [7]
    equal = spark.range(1000).select((F.col("id") % 4).alias("k"))
    assert heavy_hitters(equal, "k", 0.25) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="share"):
        heavy_hitters(equal, "k", 0)


def test_no_task_joins_much_more_than_another(spark, tmp_path):
    hot, parts, joined = stored(spark, tmp_path, 0.05)
    assert hot == ["final"]
    details, matches, earned = match_tables(spark)
    want = details.join(matches, "match_id").join(earned, ["match_id", "player_gamertag"])
    assert rows(joined.select(*want.columns)) == rows(want)
    per_task = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    counts = [r["count"] for r in per_task]
    assert len(counts) >= BUCKETS and max(counts) <= 3 * statistics.median(counts)
    assert exchanges(joined) == 0 and python_nodes(joined) == 0 and count_nodes(joined, "CartesianProduct") == 0
    plain = bucketed_match_join(*[a.unionByName(b) for a, b in (parts["d"], parts["m"], parts["e"])])
    assert rows(plain.select(*want.columns)) == rows(want)


def test_without_hot_keys_the_hot_tables_are_empty_but_for_null_keys(spark, tmp_path):
    hot, parts, joined = stored(spark, tmp_path, 0.9)
    assert hot == []
    assert parts["d"][1].where("match_id IS NOT NULL").isEmpty() and not parts["d"][1].isEmpty()
    details, _, _ = match_tables(spark)
    assert joined.count() == 2 * details.where("match_id IS NOT NULL").count()
