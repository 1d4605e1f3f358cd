"""Period by period equals all at once, on the practice tables."""

import datetime as dt

import pytest
from helpers import rows

from factdim import operators as op
from factdim import schemas
from factdim.sinks import write_period
from factdim.sources.practice import Practice
from pyspark.sql import functions as F

YEARS = range(1995, 2002)
FIRST_DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def practice(spark):
    return Practice(spark, "/root/testdata/sf0.001")


def test_actors_and_history_year_by_year(spark, practice, tmp_path):
    films = practice.actor_films()
    actors, history = str(tmp_path / "actors"), str(tmp_path / "history")
    write_period(spark.createDataFrame([], schemas.ACTORS), actors, ["current_year"])
    write_period(spark.createDataFrame([], schemas.ACTORS_HISTORY_SCD), history, ["current_year"])
    for year in YEARS:
        stored = spark.read.schema(schemas.ACTORS).parquet(actors)
        write_period(op.cumulate_actors(stored, films, year), actors, ["current_year"])
        snapshots = spark.read.schema(schemas.ACTORS).parquet(actors)
        past = spark.read.schema(schemas.ACTORS_HISTORY_SCD).parquet(history)
        write_period(op.scd2_increment(past, snapshots, year), history, ["current_year"])
    snapshots = spark.read.schema(schemas.ACTORS).parquet(actors)
    op.assert_unique_key(snapshots, schemas.KEYS["actors"])
    order = ["actorid", "current_year"]
    assert rows(snapshots.select("actor", "actorid", "films", "quality_class", "is_active", "current_year"), *order) == rows(
        op.backfill_actors(films), *order
    )
    past = spark.read.schema(schemas.ACTORS_HISTORY_SCD).parquet(history)
    for year in YEARS:
        expected = op.scd2_backfill(snapshots, as_of=year)
        got = past.filter(F.col("current_year") == year).select(*expected.columns)
        assert rows(got) == rows(expected), year
    final = op.scd2_backfill(snapshots).collect()
    by_actor = {}
    for r in sorted(final, key=lambda r: (r.actorid, r.start_year)):
        by_actor.setdefault(r.actorid, []).append(r)
    for runs in by_actor.values():
        for a, b in zip(runs, runs[1:]):
            assert a.end_year + 1 == b.start_year
            assert (a.quality_class, a.is_active) != (b.quality_class, b.is_active)


def test_dates_and_months_day_by_day(spark, practice, tmp_path):
    events, keys = practice.site_events(), ["user_id", "host"]
    end = FIRST_DAY + dt.timedelta(days=9)
    lists = op.backfill_dates(events, keys, FIRST_DAY, FIRST_DAY)
    months = op.monthly_array_backfill(events, keys, FIRST_DAY, FIRST_DAY)
    for n in range(1, 10):
        day = FIRST_DAY + dt.timedelta(days=n)
        for name, df in (("lists", lists), ("months", months)):
            df.write.parquet(str(tmp_path / f"{name}{n}"))
        lists = op.cumulate_dates(spark.read.parquet(str(tmp_path / f"lists{n}")), events, keys, day)
        months = op.monthly_array_increment(
            spark.read.parquet(str(tmp_path / f"months{n}")), events, keys, day
        )
    assert rows(lists, *keys) == rows(op.backfill_dates(events, keys, FIRST_DAY, end), *keys)
    whole = op.monthly_array_backfill(events, keys, FIRST_DAY, end)
    assert rows(months, *keys) == rows(whole, *keys)
    in_range = F.col("event_time") < F.lit(end + dt.timedelta(days=1))
    hits = op.monthly_array_explode(months, keys).agg(F.sum("hits")).first()[0]
    assert hits == events.filter(in_range).count()
    masks = op.datelist_int(lists, "activity_datelist", end, keys)
    sizes = {(r.user_id, r.host): len(r.activity_datelist) for r in lists.collect()}
    assert {(r.user_id, r.host): r.days_active for r in masks.collect()} == sizes
