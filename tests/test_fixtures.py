"""Edge cases with rows typed by hand."""

import datetime as dt

import pytest
from helpers import rows, table

from factdim import operators as op
from factdim import schemas
from factdim.functions import quality_class
from pyspark.sql import functions as F

D = dt.date


def test_dedup_keeps_one_whole_row(spark):
    games = table(
        spark,
        "game_id int, team_id int, player_id int, pts int, note string",
        (1, 1, 1, 9, "a"), (1, 1, 1, 9, "a"), (1, 1, 1, 9, "a"),
        (1, 1, 2, 9, "a"), (1, 1, 2, 7, "z"), (1, 1, 2, None, "m"),
        (None, 1, 3, 1, "n"), (None, 1, 3, 2, "n"),
    )
    keys = ["game_id", "team_id", "player_id"]
    assert rows(op.dedup(games, keys)) == [
        (None, 1, 3, 1, "n"), (1, 1, 1, 9, "a"), (1, 1, 2, None, "m"),
    ]
    assert rows(op.dedup(games, keys, ["pts"], keep="last")) == [
        (None, 1, 3, 2, "n"), (1, 1, 1, 9, "a"), (1, 1, 2, 9, "a"),
    ]
    assert rows(op.dedup(games.select(*keys), keys)) == [(None, 1, 3), (1, 1, 1), (1, 1, 2)]


def test_quality_class_boundaries(spark):
    df = spark.createDataFrame([(x,) for x in (5.9, 6.0, 7.0, 8.0, 8.1, None)], "r double")
    loose = [r[0] for r in df.select(quality_class(F.col("r"))).collect()]
    strict = [r[0] for r in df.select(quality_class(F.col("r"), strict=True)).collect()]
    assert loose == ["bad", "average", "good", "star", "star", None]
    assert strict == ["bad", "bad", "average", "good", "star", None]
    assert op.outside_domain(table(spark, "q string", ("bad",), ("ugly",), (None,)), "q", schemas.QUALITY).count() == 1


FILMS = [
    # new in 1, inactive in 2, back in 3
    ("Ann", "a", "f1", 1, 10, 8, "01"), ("Ann", "a", "f2", 1, 10, 8, "02"),
    ("Ann", "a", "f5", 3, 10, 2, "05"),
    # debut in 3
    ("Bob", "b", "f6", 3, 10, 7, "06"),
    # renamed between 1 and 2
    ("Cat", "c", "f3", 1, 10, 6, "03"), ("Kat", "c", "f4", 2, 10, 6, "04"),
]


def _actors(df):
    return {
        (r.actorid, r.current_year): (r.actor, [f.film for f in r.films], r.quality_class, r.is_active)
        for r in df.collect()
    }


EXPECTED_ACTORS = {
    ("a", 1): ("Ann", ["f1", "f2"], "star", True),
    ("a", 2): ("Ann", ["f1", "f2"], "star", False),
    ("a", 3): ("Ann", ["f1", "f2", "f5"], "bad", True),
    ("b", 3): ("Bob", ["f6"], "good", True),
    ("c", 1): ("Cat", ["f3"], "average", True),
    ("c", 2): ("Kat", ["f3", "f4"], "average", True),
    ("c", 3): ("Kat", ["f3", "f4"], "average", False),
}


@pytest.fixture(scope="module")
def films(spark):
    return spark.createDataFrame(FILMS, schemas.ACTOR_FILMS)


def test_actors_year_by_year_and_in_one_job(spark, films):
    snapshot = spark.createDataFrame([], schemas.ACTORS)
    stepwise = {}
    for year in (1, 2, 3):
        snapshot = op.cumulate_actors(snapshot, films, year)
        stepwise |= _actors(snapshot)
    assert stepwise == EXPECTED_ACTORS
    backfilled = op.backfill_actors(films)
    assert _actors(backfilled) == EXPECTED_ACTORS
    assert backfilled.schema.simpleString() == snapshot.schema.simpleString()
    status = op.backfill_actor_status(films)
    assert rows(status) == rows(backfilled.select(*status.columns))


EXPECTED_HISTORY = {
    ("a", "Ann", "star", True, 1, 1, 3), ("a", "Ann", "star", False, 2, 2, 3),
    ("a", "Ann", "bad", True, 3, 3, 3), ("b", "Bob", "good", True, 3, 3, 3),
    ("c", "Kat", "average", True, 1, 2, 3), ("c", "Kat", "average", False, 3, 3, 3),
}


def test_scd2_backfill_equals_increments(spark, films):
    snapshots = op.backfill_actors(films)
    assert set(map(tuple, op.scd2_backfill(snapshots).collect())) == EXPECTED_HISTORY
    history = spark.createDataFrame([], schemas.ACTORS_HISTORY_SCD)
    for year in (1, 2, 3):
        history = op.scd2_increment(history, snapshots, year)
        op.assert_unique_key(history, schemas.KEYS["actors_history_scd"])
    assert set(map(tuple, history.collect())) == EXPECTED_HISTORY


def test_scd2_same_year_again_and_skipped_year(spark, films):
    snapshots = op.backfill_actors(films)
    two = op.scd2_backfill(snapshots, as_of=2)
    three = op.scd2_increment(two, snapshots, 3)
    again = op.scd2_increment(two.unionByName(three), snapshots, 3)
    assert rows(again) == rows(three)
    with pytest.raises(ValueError, match="history ends at 1"):
        op.scd2_increment(op.scd2_backfill(snapshots, as_of=1), snapshots, 3)


def test_scd2_key_without_snapshot_returns_later(spark):
    snapshots = table(
        spark, "actorid string, actor string, quality_class string, is_active boolean, current_year int",
        ("x", "X", "bad", True, 1), ("x", "X", "bad", True, 2), ("x", "X", "bad", True, 4),
        ("y", "Y", None, True, 1), ("y", "Y", None, True, 2), ("y", "Y", "bad", None, 3),
        ("y", "Y", "bad", None, 4),
    )
    expected = {
        ("x", "X", "bad", True, 1, 2, 4), ("x", "X", "bad", True, 4, 4, 4),
        ("y", "Y", None, True, 1, 2, 4), ("y", "Y", "bad", None, 3, 4, 4),
    }
    assert set(map(tuple, op.scd2_backfill(snapshots).collect())) == expected
    history = op.scd2_backfill(snapshots, as_of=1)
    for year in (2, 3, 4):
        history = op.scd2_increment(history, snapshots, year)
    assert set(map(tuple, history.collect())) == expected
    bridged = op.scd2_backfill(snapshots, break_on_gap=False)
    assert ("x", "X", "bad", True, 1, 4, 4) in set(map(tuple, bridged.collect()))


def test_date_lists(spark):
    prev = table(
        spark, "user_id string, browser_type string, activity_datelist array<date>, date date",
        ("only_yesterday", "Chrome", [D(2023, 1, 29)], D(2023, 1, 30)),
        ("both", "Chrome", [D(2023, 1, 1), D(2023, 1, 30)], D(2023, 1, 30)),
        ("old_partition", "Chrome", [D(2023, 1, 29)], D(2023, 1, 29)),
    )
    at = dt.datetime(2023, 1, 31, 23, 59, 59)
    events = table(
        spark, "user_id string, browser_type string, event_time timestamp_ntz",
        ("both", "Chrome", at), ("both", "Chrome", at), ("only_today", "Edge", dt.datetime(2023, 1, 31)),
        ("both", None, at), (None, "Edge", at), ("tomorrow", "Edge", dt.datetime(2023, 2, 1)),
    )
    keys = ["user_id", "browser_type"]
    out = op.cumulate_dates(prev, events, keys, D(2023, 1, 31))
    assert rows(out) == [
        ("both", "Chrome", [D(2023, 1, 1), D(2023, 1, 30), D(2023, 1, 31)], D(2023, 1, 31)),
        ("only_today", "Edge", [D(2023, 1, 31)], D(2023, 1, 31)),
        ("only_yesterday", "Chrome", [D(2023, 1, 29)], D(2023, 1, 31)),
    ]
    trimmed = op.cumulate_dates(prev, events, keys, D(2023, 1, 31), max_history_days=2)
    assert rows(trimmed)[0][2] == [D(2023, 1, 30), D(2023, 1, 31)]
    rejected = op.split_null_keys(events, keys)[1]
    assert rejected.count() == 2


def test_backfilled_date_lists_over_several_words(spark):
    start, end = D(2023, 1, 1), D(2023, 12, 31)
    days = [D(2023, 1, 1), D(2023, 3, 4), D(2023, 3, 5), D(2023, 12, 31)]
    events = table(
        spark, "host string, event_time timestamp_ntz",
        *[("h", dt.datetime.combine(d, dt.time(5))) for d in [*days, *days]],
        ("h", dt.datetime(2022, 12, 31)), ("h", dt.datetime(2024, 1, 1)), ("i", dt.datetime(2023, 7, 1)),
    )
    out = op.backfill_dates(events, ["host"], start, end)
    assert rows(out) == [("h", days, end), ("i", [D(2023, 7, 1)], end)]
    as_map = op.as_date_map(out.withColumn("site", F.lit("s")), "site", "host", "activity_datelist", "m")
    assert as_map.first().m == {"h": days, "i": [D(2023, 7, 1)]}


def test_datelist_int_edges(spark):
    end = D(2023, 1, 31)
    lists = table(
        spark, "k string, dates array<date>",
        ("day0", [end]), ("day31", [D(2022, 12, 31)]), ("day32", [D(2022, 12, 30)]),
        ("future", [D(2023, 2, 1)]), ("empty", []), ("null", None), ("twice", [end, end]),
        ("day6", [D(2023, 1, 25)]), ("day7", [D(2023, 1, 24)]), ("day28", [D(2023, 1, 3)]),
    )
    out = {r.k: r for r in op.datelist_int(lists, "dates", end, ["k"]).collect()}
    assert out["day0"].datelist_int == 1 << 31 and out["day0"].datelist_bits == "1" + "0" * 31
    assert out["day31"].datelist_int == 1 and out["day31"].days_active == 1
    for k in ("day32", "future", "empty", "null"):
        assert out[k].datelist_int == 0 and out[k].datelist_bits == "0" * 32 and not out[k].active_28d
    assert out["twice"].days_active == 1
    assert (out["day6"].active_7d, out["day7"].active_7d) == (True, False)
    assert (out["day7"].active_28d, out["day28"].active_28d) == (True, False)


def _hits(spark, *data):
    return table(
        spark, "user_id bigint, host string, event_time timestamp_ntz",
        *[(u, h, dt.datetime(2024, 2 if len(x) == 1 else x[1], x[0], 12)) for u, h, *x in data],
    )


def test_monthly_arrays(spark):
    events = _hits(
        spark, (1, "a", 1), (1, "a", 1), (2, "a", 1), (1, "b", 5), (1, "a", 29), (None, "a", 1),
        (1, None, 1), (1, "a", 1, 3),
    )
    month = op.monthly_array_backfill(events.limit(0), ["host"], D(2024, 2, 1), D(2024, 2, 1))
    expected = None
    for day in (1, 2, 4, 5, 29):  # day 3 and 6..28 are missed
        month = op.monthly_array_increment(month, events, ["host"], D(2024, 2, day))
        if day == 5:
            expected = rows(month)
    assert expected == [
        ("a", D(2024, 2, 1), [3, 0, 0, 0, 0], [2, 0, 0, 0, 0]),
        ("b", D(2024, 2, 1), [0, 0, 0, 0, 1], [0, 0, 0, 0, 1]),
    ]
    full = op.monthly_array_backfill(events, ["host"], D(2024, 2, 1))
    assert rows(month) == rows(full)
    assert all(len(r.hit_array) == 29 for r in full.collect())
    again = op.monthly_array_increment(month, events, ["host"], D(2024, 2, 29))
    assert rows(again) == rows(month)
    march = op.monthly_array_increment(month, events, ["host"], D(2024, 3, 1))
    assert rows(march) == [("a", D(2024, 3, 1), [1], [1])]
    daily = op.monthly_array_explode(full, ["host"])
    assert daily.agg(F.sum("hits")).first()[0] == 5
    assert rows(op.monthly_array_totals(full, ["host"])) == [
        ("a", D(2024, 2, 1), 4, 3), ("b", D(2024, 2, 1), 1, 1),
    ]


def test_player_states(spark):
    seasons = table(
        spark, "player_name string, season int",
        ("p", 2), ("p", 3), ("p", 5), ("q", 1), ("q", 1), ("r", 6), ("x", 1), ("x", 4), (None, 1), ("p", None),
        ("r", 9),
    )
    out = op.player_state(seasons, entities=table(spark, "player_name string", ("p",), ("q",), ("r",), ("s",)))
    assert rows(out) == [
        ("p", 2, "New"), ("p", 3, "Continued Playing"), ("p", 4, "Retired"),
        ("p", 5, "Returned from Retirement"), ("p", 6, "Retired"), ("p", 9, "Stayed Retired"),
        ("q", 1, "New"), ("q", 2, "Retired"), ("q", 3, "Stayed Retired"), ("q", 4, "Stayed Retired"),
        ("q", 5, "Stayed Retired"), ("q", 6, "Stayed Retired"), ("q", 9, "Stayed Retired"),
        # seasons 7 and 8 were never played, so 9 follows 6
        ("r", 6, "New"), ("r", 9, "Continued Playing"),
    ]


def test_top_with_ties(spark):
    df = table(spark, "k string, v int", ("a", 5), ("b", 5), ("c", 1), ("d", None))
    assert rows(op.top_with_ties(df, "v")) == [("a", 5), ("b", 5)]
    zero = table(spark, "k string, v int", ("a", 0), ("b", 0))
    assert op.top_with_ties(zero, "v").count() == 2
    assert op.top_with_ties(df.filter("k = 'd'"), "v").count() == 0
    keyed = table(spark, "g int, k string, v int", (1, "a", 2), (1, "b", 2), (1, "c", 1), (2, "d", 0), (3, "e", None))
    assert rows(op.top_with_ties(keyed, "v", ["g"])) == [(1, "a", 2), (1, "b", 2), (2, "d", 0)]
    ordered = [r.k for r in op.ordered_desc(df, "v", "k").collect()]
    assert ordered == ["a", "b", "c", "d"]
    assert [r.k for r in op.preview(df, "v", 2).collect()] == ["a", "b"]


def test_wins_with_ties_single_team_and_three_teams(spark):
    games = table(
        spark, "game_id int, team_abbreviation string, pts int",
        (1, "A", 3), (1, "A", 4), (1, "B", 7),  # tie
        (2, "A", 9),  # one team
        (3, "A", 5), (3, "B", 3), (3, "C", None),  # three teams
        (4, "D", 1), (None, "A", 4), (3, None, 99),
    )
    assert rows(op.team_wins(games)) == [("A", 2), ("B", 1), ("C", 0)]
    assert rows(op.top_team_wins(games)) == [("A", 2)]


def test_streaks(spark):
    games = table(
        spark, "player_name string, game_id int, pts int",
        ("p", 1, 11), ("p", 2, 10), ("p", 3, 12), ("p", 4, 13), ("p", 5, None), ("p", 6, 20), ("p", 7, 20),
        ("q", 1, 30), ("q", 2, 30), ("q", 3, 30), ("z", 1, 0), (None, 1, 50),
    )
    out = op.longest_streak(games, F.col("pts") > 10)
    assert rows(out) == [("p", 2, 3, 4), ("p", 2, 6, 7), ("q", 3, 1, 3)]


def test_grouping_sets_keep_null_values_apart_from_totals(spark):
    games = table(
        spark, "player_name string, team_abbreviation string, season int, pts int",
        ("p", "A", 1, 10), ("p", "A", 1, None), ("p", None, 2, 5), ("q", "A", 1, 1),
    )
    seasons = table(spark, "player_name string, season int", ("p", 1), ("p", 2))
    got = {tuple(r)[3:] for r in op.grouping_sets_points(games, seasons).collect()}
    assert got == {
        (10, 2, "p", "A", "ALL_SEASONS"), (5, 1, "p", None, "ALL_SEASONS"),
        (10, 2, "p", "ALL_TEAMS", "1"), (5, 1, "p", "ALL_TEAMS", "2"),
        (10, 2, "ALL_PLAYERS", "A", "ALL_SEASONS"), (5, 1, "ALL_PLAYERS", None, "ALL_SEASONS"),
    }


MS = 60_000


def test_sessions(spark):
    base = 1_700_000_000_000
    events = table(
        spark, "ip string, host string, ts bigint",
        ("1", "h", base), ("1", "h", base + 5 * MS), ("1", "h", base + 10 * MS + 1),  # touch, then apart
        ("1", "g", base), ("1", "g", base), ("1", "g", base),  # same instant
        ("2", "h", base + 1), (None, "h", base), ("2", "h", None),
    )
    out = {(r.ip, r.host, r.session_start.timestamp()): r for r in op.sessionize(events).collect()}
    assert len(out) == 4
    first = out["1", "h", base / 1000]
    assert (first.event_count, first.session_end.timestamp() * 1000) == (2, base + 10 * MS)
    assert out["1", "h", (base + 10 * MS + 1) / 1000].event_count == 1
    assert out["1", "g", base / 1000].event_count == 3
    import hashlib

    assert first.session_id == hashlib.md5(f"1|h|{base}".encode()).hexdigest()
    stats = op.session_stats(op.sessionize(events), ["h", "nowhere"])
    assert rows(stats) == [("ALL", 3, 4 / 3), ("h", 3, 4 / 3)]


def test_growth_and_retention(spark):
    def day(n):
        return dt.datetime(2024, 1, n, 8)

    events = table(
        spark, "user_id int, event_time timestamp_ntz",
        (1, day(1)), (1, day(1)), (1, day(2)), (1, day(5)), (2, day(2)), (3, day(8)), (None, day(3)),
    )
    got = {r.period.day: tuple(r)[1:] for r in op.growth_accounting(events).collect()}
    # new, retained, resurrected, churned, stale, active, net change
    assert got == {
        1: (1, 0, 0, 0, 0, 1, 1), 2: (1, 1, 0, 0, 0, 2, 1), 3: (0, 0, 0, 2, 0, 0, -2),
        4: (0, 0, 0, 0, 2, 0, 0), 5: (0, 0, 1, 0, 1, 1, 1), 6: (0, 0, 0, 1, 1, 0, -1),
        7: (0, 0, 0, 0, 2, 0, 0), 8: (1, 0, 0, 0, 2, 1, 1),
    }
    shares = {r.cohort.day: (r.users, r.day_7_share, r.week_1_share) for r in op.retention(events).collect()}
    # the last day is the 8th: day 7 of the later cohorts has not happened
    assert shares == {1: (1, 0.0, 1.0), 2: (1, None, None), 8: (1, None, None)}
    engaged = {r.date.day: (r.dau, r.mau) for r in op.engagement(events, window=3).collect()}
    assert engaged == {
        1: (1, 1), 2: (2, 2), 3: (0, 2), 4: (0, 2), 5: (1, 1), 6: (0, 1), 7: (0, 1), 8: (1, 1),
    }


def test_dirty_kills_and_match_reports(spark):
    details = table(
        spark, "match_id string, player_gamertag string, player_total_kills string",
        ("m1", "p", "3"), ("m1", "p", "x"), ("m2", "p", ""), ("m2", "q", " 4 "), ("m3", "r", "9.5"),
    )
    out = {r.player_gamertag: r.avg_kills_per_game for r in op.avg_kills_per_game(details).collect()}
    assert out == {"p": 1.5, "q": 4.0, "r": None}


def test_medals_count_rows_and_keep_unknown_maps(spark):
    medals = table(spark, "medal_id string, name string", ("7", "Killing Spree"), ("8", "Other"))
    earned = table(
        spark, "match_id string, player_gamertag string, medal_id string, n int",
        ("m1", "p", "7", 2), ("m1", "q", "7", 1), ("m2", "p", "7", 5), ("m1", "p", "8", 1), ("m9", "p", "7", 1),
    )
    matches = table(spark, "match_id string, mapid string", ("m1", "1"), ("m2", "77"))
    maps = table(spark, "mapid string, name string", ("1", "Arena"))
    assert rows(op.medal_maps(earned, medals, matches, maps)) == [(None, None, 2), ("1", "Arena", 2)]
    weighted = op.medal_maps(earned, medals, matches, maps, weight_col="n")
    assert rows(weighted) == [(None, None, 6), ("1", "Arena", 3)]


def test_key_checks(spark):
    df = table(spark, "k int, v int", (1, 1), (2, 2))
    assert op.assert_unique_key(df, ["k"]) is df
    with pytest.raises(ValueError):
        op.assert_unique_key(df.unionByName(df), ["k"])
    with pytest.raises(ValueError):
        op.assert_unique_key(table(spark, "k int", (None,)), ["k"])
    flagged = op.with_exists_flag(df, table(spark, "k int", (2,), (2,)), ["k"], "seen")
    assert rows(flagged) == [(1, 1, False), (2, 2, True)]


def test_experiments(spark):
    users = spark.range(5000).select(F.col("id").alias("user_id"))
    cells = {"A": 50, "B": 30, "C": 20}
    assigned = op.assign_cells(users.union(users), "exp", cells)
    sizes = {r.cell: r.users for r in op.cell_sizes(assigned).collect()}
    assert sum(sizes.values()) == 5000
    assert all(abs(sizes[c] / 50 - share) < 3 for c, share in cells.items())
    other = op.assign_cells(users, "other", cells).withColumnRenamed("cell", "c2")
    same = assigned.join(other, "user_id").filter("cell = c2").count()
    assert 1500 < same < 2300
    with pytest.raises(ValueError):
        op.assign_cells(users, "exp", {"A": 50})
    facts = table(spark, "user_id int, v int", (1, 1), (1, 1), (2, 4), (9, 9))
    assignment = table(
        spark, "user_id int, experiment string, cell string",
        (1, "e", "A"), (2, "e", "A"), (3, "e", "B"), (4, "e", "B"), (5, "e", "C"),
    )
    out = {r.cell: r for r in op.cell_metrics(assignment, facts, {"v": F.sum("v")}, "A").collect()}
    assert (out["A"].mean, out["A"].variance, out["A"].lift) == (3.0, 2.0, None)
    assert (out["B"].mean, out["B"].lift, out["B"].welch_z) == (0.0, -1.0, -3.0)
    assert (out["C"].users, out["C"].variance, out["C"].welch_z) == (1, None, None)
    users = table(spark, "user_id int, experiment string, cell string", *[(i, "e", "A") for i in range(3)])
    large = table(spark, "user_id int, v double, n bigint", *[(i, 1e9 + 2 * i, 3_000_000_000 + i) for i in range(3)])
    out = {r.metric: r for r in op.cell_metrics(users, large, {"v": F.sum("v"), "n": F.sum("n")}, "A").collect()}
    assert (out["v"].variance, out["n"].variance) == (4.0, 1.0)


def test_quality_checks(spark):
    daily = table(
        spark, "date date, value int",
        (D(2024, 1, 1), 100), (D(2024, 1, 2), 80), (D(2024, 1, 3), 64), (D(2024, 1, 4), 64),
        (D(2024, 1, 6), 10), (D(2024, 1, 7), 8), (D(2024, 1, 8), 6),
    )
    assert [r.date.day for r in op.consecutive_drop_alert(daily).collect()] == [3, 8]
    gap = table(spark, "date date, value int", (D(2024, 1, 1), 100), (D(2024, 1, 2), 50), (D(2024, 1, 4), 10))
    assert [r.date.day for r in op.consecutive_drop_alert(gap).collect()] == [3]
    assert op.consecutive_drop_alert(gap, absent=None).collect() == []
    missing = op.missing_periods(daily, "date")
    assert rows(missing) == [(D(2024, 1, 5),)]
    stamped = daily.select(F.explode(F.sequence(F.lit(1), "value")).alias("i"), F.col("date").alias("ts"))
    assert [r.date.day for r in op.volume_drop(stamped, "ts", 2, 0.5).collect()] == [5, 6]
    report = {r.column: r for r in op.schema_conformance(
        table(spark, "a string, b int", ("1", None), ("x", 2), (None, 3), ("4", 4)),
        schemas.T.StructType.fromDDL("a int, c string"),
    ).collect()}
    assert (report["a"].null_rate, report["a"].bad_cast_rate) == (0.25, 0.25)
    assert (report["c"].present, report["b"].expected_type) == (False, None)
    fresh = op.freshness({"t": (table(spark, "ts timestamp_ntz", (dt.datetime(2024, 1, 1, 5),)), "ts")}, dt.datetime(2024, 1, 1, 6, 0, 59))
    assert fresh.first().lag_minutes == 60


def test_profit(spark):
    lines = table(
        spark, "l_orderkey int, l_linenumber int, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
        (1, 1, 100.0, 0.1, dt.datetime(2024, 1, 1)), (1, 2, 0.05, 0.5, dt.datetime(2024, 1, 1, 9)),
    )
    assert [r.profit_cents for r in op.unit_profit(lines).collect()] == [9000, 3]
    assert rows(op.aggregate_profit(lines)) == [(D(2024, 1, 1), 2, 9003)]


def test_increments_refuse_a_skipped_period(spark):
    films = table(
        spark, "actor string, actorid string, film string, year int, votes int, rating int, filmid string",
        ("A", "a", "x", 1999, 1, 8, "f1"), ("B", "b", "y", 1999, 1, 8, "f2"), ("A", "a", "z", 2001, 1, 8, "f3"),
    )
    first = op.backfill_actors(films, 1999)
    with pytest.raises(ValueError):
        op.cumulate_actors(first, films, 2001)
    second = op.cumulate_actors(first, films, 2000)
    assert {r.actorid for r in op.cumulate_actors(second, films, 2001).collect()} == {"a", "b"}
    assert op.cumulate_actors(first.limit(0), films, 1999).count() == 2
    events = table(spark, "k string, event_time timestamp_ntz", ("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2024, 1, 3, 5)))
    lists = op.backfill_dates(events, ["k"], D(2024, 1, 1), D(2024, 1, 1))
    with pytest.raises(ValueError):
        op.cumulate_dates(lists, events, ["k"], D(2024, 1, 3))


def test_history_increment_again(spark):
    status = table(
        spark, "actor string, actorid string, quality_class string, is_active boolean, current_year int",
        ("A", "a", "good", True, 1999), ("A", "a", "good", True, 2000), ("A", "a", "bad", True, 2001),
        ("B", "b", "good", True, 2000), ("B", "b", "good", True, 2001), ("C", "c", "star", True, 2001),
    )
    history = op.scd2_backfill(status, as_of=2001)
    again = op.scd2_increment(history, status, 2001)
    assert sorted(map(str, again.select(history.columns).collect())) == sorted(map(str, history.collect()))
