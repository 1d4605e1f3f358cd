"""The plans the jobs are meant to have."""

import re

import pytest

from factdim import operators as op
from factdim.plans.inspect import count_nodes, exchanges, executed_plan, python_nodes
from factdim.plans.jobs import JOBS
from factdim.sources.practice import Practice
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
WRITES = {"monthly_array_upsert", "bucketed_match_join", "hot_match_join", "actors_history_stored", "layout_experiment", "sessions_stream"}


@pytest.fixture(scope="module")
def practice(spark):
    return Practice(spark, FOLDER)


@pytest.mark.parametrize("name", sorted(set(JOBS) - WRITES))
def test_no_python_and_no_cross_join(spark, name):
    df = JOBS[name](spark, FOLDER)
    assert python_nodes(df) == 0
    plan = executed_plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# jobs whose last step is a running value over the calendar: one row per day or week
CALENDAR = {"growth_daily", "growth_weekly", "daily_growth_rate", "engagement"}


@pytest.mark.parametrize("name", sorted(set(JOBS) - WRITES - CALENDAR))
def test_no_window_without_partition(spark, name):
    for line in executed_plan(JOBS[name](spark, FOLDER)).splitlines():
        if re.search(r"[+:]- Window \[", line):
            assert re.search(r"\], \[[^\[\]]+\], \[[^\[\]]*\]$|\], \[[^\[\]]+\]$", line), line


def test_filters_and_columns_reach_the_scan(practice):
    import datetime as dt

    events = practice.site_events()
    today = op.cumulate_dates(
        op.backfill_dates(events, ["host"], dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
        events, ["host"], dt.date(2024, 1, 3),
    )
    plan = executed_plan(today)
    assert plan.count("GreaterThanOrEqual(ts,2024-01-0") == 2 and plan.count("LessThan(ts,2024-01-0") == 2
    assert "event_type" not in plan and "value" not in plan
    top = executed_plan(op.avg_kills_per_game(practice.match_details()))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>", top)


def test_match_fact_broadcasts_only_small_names(practice):
    plan = executed_plan(JOBS["match_fact"](practice.spark, FOLDER))
    for key in ("medal_id", "_mapid"):
        assert len(re.findall(rf"BroadcastHashJoin \[{key}#", plan)) == 1
    large = practice.spark.range(100).withColumnRenamed("id", "k")
    hinted = op.checked_broadcast(large, 800)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint (strategy=broadcast)" in hinted
    assert "ResolvedHint" not in op.checked_broadcast(large, 799)._jdf.queryExecution().analyzed().toString()


def test_dedup_and_leaders_drop_rows_before_the_shuffle(practice):
    for df in (
        op.dedup(practice.game_details(), ["game_id", "team_id", "player_id"]),
        op.top_with_ties(practice.game_details(), "pts", ["team_id"]),
    ):
        plan = executed_plan(df)
        below_shuffle = plan[plan.index("Exchange hashpartitioning") :]
        assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_leader_reuses_the_aggregate_shuffle(practice):
    df = op.top_player_for_team(practice.game_details())
    df.collect()
    assert "ReusedExchange" in executed_plan(df)


def test_shuffle_counts(practice):
    games = practice.game_details()
    assert exchanges(op.dedup(games, ["game_id", "team_id", "player_id"])) == 1
    assert exchanges(op.sessionize(practice.web_events())) == 2
    lists = op.backfill_dates(practice.site_events(), ["host"], *_january())
    assert exchanges(lists) == 1
    assert exchanges(op.datelist_int(lists, "activity_datelist", _january()[1], ["host"])) == 1
    status = op.backfill_actor_status(practice.actor_films(), 2001)
    assert exchanges(op.scd2_backfill(status, as_of=2001)) == exchanges(status) == 2
    # games by (player, slot) twice, slots by player, pieces and offsets to meet, runs by player
    assert exchanges(op.longest_streak(games, F.col("pts") > 10)) == 5
    assert count_nodes(op.preview(op.avg_kills_per_game(practice.match_details()), "avg_kills_per_game"), "TakeOrderedAndProject") == 1


def _january():
    import datetime as dt

    return dt.date(2024, 1, 1), dt.date(2024, 1, 31)


def test_large_dimension_joins_by_shuffle_with_the_same_rows(practice, monkeypatch):
    from factdim.operators import matches, relational

    def reports():
        tables = practice.match_details(), practice.matches(), practice.medals_matches_players()
        names = practice.medals(), practice.maps()
        return [
            op.match_fact(*tables, *names),
            op.match_fact(*tables, *names, partitions=16),
            op.most_played_map(tables[1], names[1]),
            op.medal_maps(tables[2], names[0], tables[1], names[1]),
        ]

    small = [sorted(map(str, df.collect())) for df in reports()]
    assert small[0] == small[1]
    monkeypatch.setattr(
        matches, "checked_broadcast", lambda df: relational.checked_broadcast(df, max_bytes=3)
    )
    threshold = practice.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    practice.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = reports()
        assert all("BroadcastHashJoin" not in executed_plan(df) for df in large)
        assert [sorted(map(str, df.collect())) for df in large] == small
    finally:
        practice.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", ["dedup_games", "max_wins_in_stretch", "longest_streak_all_players", "longest_streak_one_player"])
def test_sorts_of_narrow_rows_get_small_tasks(spark, name):
    """Split sizes and partitions of these jobs do not follow the session, which keeps its own."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    df = JOBS[name](spark, FOLDER)
    assert {int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\)", executed_plan(df))} == {200}
    assert df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    assert df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert {k: spark.conf.get(k) for k in before} == before and spark.conf.get("spark.sql.shuffle.partitions") == "8"
