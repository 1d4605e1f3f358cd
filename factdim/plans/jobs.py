"""The registered jobs: every operator on the practice tables, as (spark, folder) -> DataFrame.

Array columns are rendered as text, and timestamps without zone, so that results can be compared
with any SQL engine.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..functions import flat_text
from ..session import bucket_join_session, configure, scratch_dir, small_task_session
from ..sinks import (
    HistoryTable,
    compare_layouts,
    heavy_hitters,
    upsert_partitions,
    write_bucketed,
    write_bucketed_hot,
    write_period,
)
from ..sources.practice import HOSTS, Practice
from ..sources import decode_web_events, read_web_events
from ..streaming import (
    accounts,
    latest_sessions,
    session_table,
    sessionize_stream,
    start_intake,
    start_session_stream,
)

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
DAY = dt.timedelta(days=1)
AS_OF = dt.datetime(2024, 2, 1, 6, 0)
# Fixed value: small enough that the practice tables have many slots too.
GAMES_PER_SLOT = 5000
CELLS = {"A": 34, "B": 33, "C": 33}
LAYOUTS = {
    "by_playlist": (["playlist_id"], ["mapid"]),
    "by_map": (["mapid"], ["playlist_id"]),
    "by_both": (["playlist_id", "mapid"], []),
}


def job(
    function: Callable[[Practice], DataFrame], session: Callable[[SparkSession], SparkSession] = configure
) -> Callable[[Practice], DataFrame]:
    """Register ``function`` under its name; it gets its tables in ``session``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Practice(session(spark), folder))

    run.__doc__ = function.__doc__
    JOBS[function.__name__] = run
    return function


# for jobs that sort a whole table of narrow rows
small_task_job = partial(job, session=small_task_session)


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: flat_text(F.col(c)) for c in columns})


def _films_text(df: DataFrame) -> DataFrame:
    film = lambda f: F.concat_ws(":", f["filmid"], f["film"], f["votes"], f["rating"])
    return df.withColumn("films", F.array_join(F.transform("films", film), ";"))


def _no_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- deduplication and games ------------------------------------------------------------------


@small_task_job
def dedup_games(p: Practice) -> DataFrame:
    return op.dedup(p.game_details(), ["game_id", "team_id", "player_id"])


@job
def game_grouping_sets(p: Practice) -> DataFrame:
    return op.grouping_sets_points(p.game_details(), p.player_seasons())


@job
def game_grouping_sets_career(p: Practice) -> DataFrame:
    """Seasons joined by player only, so each game counts once per season of its player."""
    return op.grouping_sets_points(p.game_details(), p.player_seasons(), ["player_name"])


@job
def top_player_for_team(p: Practice) -> DataFrame:
    return op.top_player_for_team(p.game_details())


@job
def top_player_season(p: Practice) -> DataFrame:
    return op.top_player_season(p.game_details(), p.player_seasons())


@job
def team_wins(p: Practice) -> DataFrame:
    return op.team_wins(p.game_details(two_teams=True))


@job
def top_team_wins(p: Practice) -> DataFrame:
    return op.top_team_wins(p.game_details(two_teams=True))


@small_task_job
def max_wins_in_stretch(p: Practice) -> DataFrame:
    return op.max_wins_in_stretch(p.game_details(two_teams=True), 90, slots=GAMES_PER_SLOT, block_rows=GAMES_PER_SLOT)


def _streaks(p: Practice, games: DataFrame) -> DataFrame:
    one_row_per_game = op.dedup(
        games.select("game_id", "player_name", "pts"), ["game_id", "player_name"]
    )
    return op.longest_streak(one_row_per_game, F.col("pts") > 10, slots=GAMES_PER_SLOT)


@small_task_job
def longest_streak_all_players(p: Practice) -> DataFrame:
    return _streaks(p, p.game_details())


@small_task_job
def longest_streak_one_player(p: Practice) -> DataFrame:
    return _streaks(p, p.game_details().filter(F.col("player_name") == "Player#7"))


# --- players and actors -----------------------------------------------------------------------


@job
def player_state(p: Practice) -> DataFrame:
    return op.player_state(p.player_seasons(), entities=p.players())


def _stored(p: Practice, df: DataFrame, label: str, period: str) -> DataFrame:
    """``df`` written by period and read back, so that a job reads the one stored period it continues."""
    path = scratch_dir(p.spark, label)
    write_period(df, path, [period])
    return p.spark.read.schema(df.schema).parquet(path)


@job
def actors_increment(p: Practice) -> DataFrame:
    films = p.actor_films()
    before = _stored(p, op.backfill_actors(films, p.last_year - 1), "actors", "current_year")
    return _films_text(op.cumulate_actors(before, films, p.last_year))


@job
def actors_backfill(p: Practice) -> DataFrame:
    return _films_text(op.backfill_actors(p.actor_films()))


@job
def actors_scd2_backfill(p: Practice) -> DataFrame:
    return op.scd2_backfill(op.backfill_actor_status(p.actor_films()), as_of=p.last_year)


@job
def actors_scd2_increment(p: Practice) -> DataFrame:
    status = op.backfill_actor_status(p.actor_films(), p.last_year)
    history = op.scd2_backfill(status, as_of=p.last_year - 1)
    return op.scd2_increment(history, status, p.last_year, last_period=p.last_year - 1)


@job
def actors_scd2_rerun(p: Practice) -> DataFrame:
    """The last year run again on the history that holds it already."""
    status = op.backfill_actor_status(p.actor_films(), p.last_year)
    history = op.scd2_backfill(status, as_of=p.last_year)
    return op.scd2_increment(history, status, p.last_year, last_period=p.last_year)


@job
def actors_history_stored(p: Practice) -> DataFrame:
    """A stored history loaded three years back, continued year by year, the last year run twice; then read back."""
    status = op.backfill_actor_status(p.actor_films(), p.last_year)
    table = HistoryTable(p.spark, scratch_dir(p.spark, "history"))
    loaded = p.last_year - 3
    table.load(op.scd2_backfill(status, as_of=loaded), loaded)
    for year in [*range(loaded + 1, p.last_year + 1), p.last_year]:
        table.increment(status, year)
    return table.as_of()


# --- site activity ----------------------------------------------------------------------------

_DEVICE_KEYS = ["user_id", "browser_type"]


def _device_lists(p: Practice) -> DataFrame:
    return op.backfill_dates(p.device_days(), _DEVICE_KEYS, p.first_day, p.last_day)


def _lists_increment(p: Practice, events: DataFrame, keys: list[str]) -> DataFrame:
    lists = op.backfill_dates(events, keys, p.first_day, p.last_day - DAY)
    before = _stored(p, lists, "date_lists", "date")
    return _text(op.cumulate_dates(before, events, keys, p.last_day), "activity_datelist")


@job
def device_dates_increment(p: Practice) -> DataFrame:
    return _lists_increment(p, p.device_days(), _DEVICE_KEYS)


@job
def device_dates_backfill(p: Practice) -> DataFrame:
    return _text(_device_lists(p), "activity_datelist")


@job
def device_dates_map(p: Practice) -> DataFrame:
    """One row per user; the map is rendered with its browsers in name order."""
    mapped = op.as_date_map(
        _device_lists(p), "user_id", "browser_type", "activity_datelist", "activity"
    )
    rendered = F.array_join(
        F.transform(
            F.array_sort(F.map_keys("activity")),
            lambda k: F.concat(k, F.lit("="), flat_text(F.element_at("activity", k))),
        ),
        ";",
    )
    return mapped.withColumn("activity", rendered)


@job
def host_dates_increment(p: Practice) -> DataFrame:
    return _lists_increment(p, p.site_events(), ["host"])


@job
def user_host_dates_increment(p: Practice) -> DataFrame:
    return _lists_increment(p, p.site_events(), ["user_id", "host"])


@job
def host_dates_backfill(p: Practice) -> DataFrame:
    lists = op.backfill_dates(p.site_events(), ["host"], p.first_day, p.last_day)
    return _text(lists, "activity_datelist")


@job
def datelist_int(p: Practice) -> DataFrame:
    return op.datelist_int(_device_lists(p), "activity_datelist", p.last_day, _DEVICE_KEYS)


def _monthly(p: Practice, keys: list[str], end: dt.date) -> DataFrame:
    return op.monthly_array_backfill(p.site_events(), keys, end.replace(day=1), end)


def _monthly_increment(p: Practice, keys: list[str]) -> DataFrame:
    before = _stored(p, _monthly(p, keys, p.last_day - DAY), "months", "month")
    after = op.monthly_array_increment(before, p.site_events(), keys, p.last_day)
    return _text(after, "hit_array", "unique_visitors")


@job
def monthly_array_increment(p: Practice) -> DataFrame:
    return _monthly_increment(p, ["host"])


@job
def monthly_array_increment_by_user(p: Practice) -> DataFrame:
    return _monthly_increment(p, ["user_id", "host"])


@job
def monthly_array_backfill(p: Practice) -> DataFrame:
    return _text(_monthly(p, ["host"], p.last_day), "hit_array", "unique_visitors")


@job
def monthly_array_explode(p: Practice) -> DataFrame:
    return op.monthly_array_explode(_monthly(p, ["host"], p.last_day), ["host"])


@job
def monthly_array_totals(p: Practice) -> DataFrame:
    return op.monthly_array_totals(_monthly(p, ["host"], p.last_day), ["host"])


@job
def monthly_array_upsert(p: Practice) -> DataFrame:
    """The last two days loaded into a stored table, the last one twice; then read back."""
    path, keys = scratch_dir(p.spark, "host_activity"), ["host"]
    events, key = p.site_events(), ["host", "month"]
    first = p.last_day.replace(day=1)
    loaded = max(first, p.last_day - 2 * DAY)
    write_period(_monthly(p, keys, loaded), path, ["month"])
    for day in [d for d in (p.last_day - DAY, p.last_day) if d > loaded] + [p.last_day]:
        stored = p.spark.read.parquet(path)
        updates = op.monthly_array_increment(stored, events, keys, day)
        upsert_partitions(p.spark, path, updates, key, ["month"], [{"month": first}])
    stored = p.spark.read.parquet(path).select("host", "month", "hit_array", "unique_visitors")
    return _text(stored, "hit_array", "unique_visitors")


def _visitor_days(p: Practice) -> DataFrame:
    """The stored visitors per host and day; the last day was loaded twice."""
    path, days = scratch_dir(p.spark, "visitors"), op.visitor_bitmaps(p.site_events(), ["host"])
    write_period(days, path, ["date"])
    write_period(days.where(F.col("date") == p.last_day), path, ["date"])
    return p.spark.read.schema(days.schema).parquet(path)


@job
def visitors_by_month(p: Practice) -> DataFrame:
    return op.count_visitors(_visitor_days(p), ["host", F.trunc("date", "month").alias("month")])


@job
def visitors_by_week(p: Practice) -> DataFrame:
    """Over all hosts."""
    return op.count_visitors(_visitor_days(p), [F.trunc("date", "week").alias("week")])


@job
def visitors_trailing(p: Practice) -> DataFrame:
    """Of the seven days up to each day, per host."""
    return op.trailing_visitors(_visitor_days(p), 7, ["host"])


@job
def segment_upsert(p: Practice) -> DataFrame:
    """Orders by status, stored without a partition name for 'P'; two partitions, one NULL, updated twice."""
    path = scratch_dir(p.spark, "orders_by_status")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = p.table("orders").select("o_orderkey", status.alias("status"), F.col("o_totalprice").alias("price"))
    write_period(orders, path, ["status"])
    updates = orders.filter((F.col("o_orderkey") % 3 == 0) & (F.col("status").isNull() | (F.col("status") == "F")))
    for _ in range(2):
        dearer = updates.withColumn("price", F.col("price") + 1)
        upsert_partitions(p.spark, path, dearer, ["o_orderkey", "status"], ["status"])
    return p.spark.read.parquet(path).select("o_orderkey", "status", "price")


# --- matches ----------------------------------------------------------------------------------


@job
def match_fact(p: Practice) -> DataFrame:
    return op.match_fact(
        p.match_details(), p.matches(), p.medals_matches_players(), p.medals(), p.maps()
    )


@job
def bucketed_match_join(p: Practice) -> DataFrame:
    """Three tables stored in 16 buckets each and joined from there."""
    folder = scratch_dir(p.spark, "buckets")
    suffix = folder.rsplit("-", 1)[1]
    tables = {
        "match_details": p.match_details(),
        "matches": p.matches().withColumn("completion_date", F.to_date("completion_date")),
        "medals_matches_players": p.medals_matches_players(),
    }
    for name, df in tables.items():
        write_bucketed(df, f"{name}_{suffix}", 16, "match_id", f"{folder}/{name}")
    reader = bucket_join_session(p.spark)
    return op.bucketed_match_join(*[reader.table(f"{name}_{suffix}") for name in tables])


@job
def hot_match_join(p: Practice) -> DataFrame:
    """The bucketed join with one match that holds a third of the rows."""
    folder = scratch_dir(p.spark, "hot_buckets")
    suffix = folder.rsplit("-", 1)[1]
    tables = {
        "details": p.crowded(p.match_details()),
        "matches": p.crowded(p.matches().withColumn("completion_date", F.to_date("completion_date"))),
        "earned": p.crowded(p.medals_matches_players()),
    }
    hot = sorted({m for name in ("details", "earned") for m in heavy_hitters(tables[name], "match_id")})
    reader, parts = bucket_join_session(p.spark), []
    for name, df in tables.items():
        spread = [c for c in df.columns if c == "player_gamertag"]
        stored = f"{name}_{suffix}"
        write_bucketed_hot(df, stored, 16, "match_id", hot, spread, f"{folder}/{name}")
        parts += [reader.table(f"{stored}_cold"), reader.table(f"{stored}_hot")]
    return op.hot_match_join(*parts)


@job
def avg_kills_per_game(p: Practice) -> DataFrame:
    return op.avg_kills_per_game(p.match_details())


@job
def most_played_playlist(p: Practice) -> DataFrame:
    return op.most_played_playlist(p.matches())


@job
def most_played_map(p: Practice) -> DataFrame:
    return op.most_played_map(p.matches(), p.maps())


@job
def medal_maps(p: Practice) -> DataFrame:
    return op.medal_maps(p.medals_matches_players(), p.medals(), p.matches(), p.maps())


@job
def top_killers_preview(p: Practice) -> DataFrame:
    return op.preview(op.avg_kills_per_game(p.match_details()), "avg_kills_per_game", 5)


@job
def layout_experiment(p: Practice) -> DataFrame:
    """Rows and partition values read back from every layout of the fact.

    The fact is written once and every layout is made from that table.  Sizes depend on the writer
    (see ``compare_layouts``) and are left to the tests.
    """
    base = scratch_dir(p.spark, "layouts")
    match_fact(p).write.parquet(f"{base}/fact")
    compare_layouts(p.spark.read.parquet(f"{base}/fact"), LAYOUTS, base)
    found = []
    for name, (partition_cols, _) in LAYOUTS.items():
        per_value = p.spark.read.parquet(f"{base}/{name}").groupBy(*partition_cols).agg(F.count("*").alias("_n"))
        found.append(
            per_value.agg(
                F.lit(name).alias("layout"), F.sum("_n").alias("rows"), F.count("*").alias("partition_values")
            )
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- sessions ---------------------------------------------------------------------------------


@job
def sessions(p: Practice) -> DataFrame:
    return _no_zone(op.sessionize(p.web_events()), "session_start", "session_end")


@job
def sessions_stream(p: Practice) -> DataFrame:
    """Run the stream to the end of the stored events and read what it wrote."""
    base = scratch_dir(p.spark, "sessions")
    query = start_session_stream(
        sessionize_stream(p.web_event_stream()), f"{base}/out", f"{base}/state", available_now=True
    )
    query.awaitTermination()
    return _no_zone(latest_sessions(p.spark, f"{base}/out"), "session_start", "session_end")


SLICES = 5


@job
def sessions_upsert(p: Practice) -> DataFrame:
    """Events that arrive in slices; the stream is started anew for each and upserts the sessions it closes."""
    base = scratch_dir(p.spark, "session_table")
    table = session_table(p.spark, f"{base}/table")
    arriving = p.web_events(p.table("events").withColumn("slice", p.day_slice(SLICES)), "slice")
    for number in range(SLICES):
        arriving.filter(F.col("slice") == number).drop("slice").write.json(f"{base}/in/slice={number}")
        closing = sessionize_stream(read_web_events(p.spark, f"{base}/in", streaming=True))
        query = start_session_stream(closing, table, f"{base}/state", available_now=True)
        query.awaitTermination()
    return _no_zone(table.current(closing.schema), "session_start", "session_end")


@job
def intake_report(p: Practice) -> DataFrame:
    """Rows accepted, late and rejected in each batch of a stream of lines, some of them broken or late."""
    base = scratch_dir(p.spark, "intake")
    lines = p.web_event_lines(SLICES)
    for number in range(SLICES):
        lines.filter(F.col("slice") == number).select("value").write.text(f"{base}/in/slice={number}")
        arriving = p.spark.readStream.schema("value string").text(f"{base}/in")
        start_intake(arriving, f"{base}/out", f"{base}/state", available_now=True).awaitTermination()
    return accounts(p.spark, f"{base}/out").select("batch_id", "accepted", "late", "rejected")


@job
def sessions_from_lines(p: Practice) -> DataFrame:
    """Sessions of events stored as JSON lines; broken lines are left out."""
    path = scratch_dir(p.spark, "lines")
    p.web_event_lines().select("value").write.text(path)
    return _no_zone(op.sessionize(read_web_events(p.spark, path)), "session_start", "session_end")


@job
def sessions_from_messages(p: Practice) -> DataFrame:
    """Sessions of events that come as message values; broken messages are left out."""
    return _no_zone(op.sessionize(decode_web_events(p.web_event_lines())), "session_start", "session_end")


@job
def session_stats(p: Practice) -> DataFrame:
    return op.session_stats(op.sessionize(p.web_events()), HOSTS)


# --- data checks ------------------------------------------------------------------------------


@job
def consecutive_drop_alert(p: Practice) -> DataFrame:
    daily = (
        p.table("events")
        .groupBy(F.to_date("ts").alias("date"), "event_type", "user_id")
        .agg(F.count("*").alias("value"))
    )
    return op.consecutive_drop_alert(daily, keys=["event_type", "user_id"])


@job
def missing_days(p: Practice) -> DataFrame:
    return op.missing_periods(p.site_events(), "event_time", ["user_id"])


@job
def volume_drop(p: Practice) -> DataFrame:
    return op.volume_drop(p.table("events"), "ts", 7, 0.9, ["event_type", "user_id"])


EXPECTED_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.DateType()),
        T.StructField("user_id", T.ShortType()),
        T.StructField("event_type", T.IntegerType()),
        T.StructField("session_id", T.StringType()),
    ]
)


@job
def schema_conformance(p: Practice) -> DataFrame:
    return op.schema_conformance(p.table("events"), EXPECTED_EVENTS)


@job
def freshness(p: Practice) -> DataFrame:
    tables = {
        "events": (p.table("events"), "ts"),
        "orders": (p.table("orders"), "o_orderdate"),
        "lineitem": (p.table("lineitem"), "l_shipdate"),
    }
    return _no_zone(op.freshness(tables, AS_OF), "latest")


# --- business metrics and experiments ---------------------------------------------------------


@job
def unit_profit(p: Practice) -> DataFrame:
    return op.unit_profit(p.table("lineitem"))


@job
def aggregate_profit(p: Practice) -> DataFrame:
    return op.aggregate_profit(p.table("lineitem"))


@job
def growth_daily(p: Practice) -> DataFrame:
    return op.growth_accounting(p.site_events())


@job
def growth_weekly(p: Practice) -> DataFrame:
    return op.growth_accounting(p.site_events(), grain="week")


@job
def daily_growth_rate(p: Practice) -> DataFrame:
    return op.daily_growth(p.site_events())


@job
def engagement(p: Practice) -> DataFrame:
    return op.engagement(p.site_events())


def _cells(p: Practice) -> DataFrame:
    return op.assign_cells(p.table("events"), "feed_layout", CELLS)


@job
def experiment_cells(p: Practice) -> DataFrame:
    return _cells(p)


@job
def experiment_metrics(p: Practice) -> DataFrame:
    metrics = {
        "clicks": F.count_if(F.col("event_type") == "click"),
        "errors": F.count_if(F.col("event_type") == "error"),
        "events": F.count("*"),
    }
    compared = op.cell_metrics(_cells(p), p.table("events"), metrics, "A")
    return compared.withColumns({c: F.round(c, 6) for c in ("variance", "lift", "welch_z")})


@job
def retention(p: Practice) -> DataFrame:
    return op.retention(p.site_events())
