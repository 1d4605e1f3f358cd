"""Jobs on tables that reach further than the practice tables: another month, another year."""

import os

import pytest
from compare import TABLES, connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

SOURCE = "/root/testdata/sf0.001"
NAMES = [
    "actors_increment", "actors_scd2_increment", "actors_scd2_rerun", "device_dates_increment", "host_dates_backfill",
    "datelist_int", "monthly_array_increment", "monthly_array_upsert", "monthly_array_totals", "sessions_upsert",
]


@pytest.fixture(scope="module", params=[33, 32])
def folder(spark, tmp_path_factory, request):
    """Every third event comes so many days later, the last one on a 3rd or 2nd of March; some films in 2003."""
    base = tmp_path_factory.mktemp("further")
    for table in TABLES:
        if table not in ("events", "orders"):
            os.symlink(f"{SOURCE}/{table}.parquet", base / f"{table}.parquet")
    events = spark.read.parquet(f"{SOURCE}/events.parquet")
    later = F.when(F.col("event_id") % 3 == 0, F.col("ts") + F.expr(f"INTERVAL {request.param} DAYS")).otherwise(F.col("ts"))
    events.withColumn("ts", later.cast(events.schema["ts"].dataType)).coalesce(1).write.parquet(str(base / "events"))
    orders = spark.read.parquet(f"{SOURCE}/orders.parquet")
    moved = F.when(F.col("o_orderkey") % 5 == 0, F.add_months("o_orderdate", 24)).otherwise(F.col("o_orderdate"))
    orders.withColumn("o_orderdate", moved.cast(orders.schema["o_orderdate"].dataType)).coalesce(1).write.parquet(str(base / "orders"))
    for table in ("events", "orders"):
        (file,) = (base / table).glob("part-*.parquet")
        os.symlink(file, base / f"{table}.parquet")
    return str(base)


@pytest.mark.parametrize("name", NAMES)
def test_job_follows_its_tables(spark, folder, name):
    df = entry_points.queries()[name](spark, folder)
    assert differences(df, connect(folder), entry_points.oracle_sql()[name]) == []
