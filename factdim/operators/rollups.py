"""Game statistics: grouping sets, leaders, wins, rolling wins and streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import BLOCK_ROWS, SLOT_WIDTH, rolling_sum, slot_of, slot_offsets, with_offsets
from .relational import ordered_desc, top_with_ties


def _points() -> Column:
    return F.coalesce(F.col("pts"), F.lit(0)).cast("bigint")


def _season_points(
    games: DataFrame,
    seasons: DataFrame,
    join_keys: Sequence[str],
    dims: Sequence[str],
) -> DataFrame:
    """Points and games per ``dims`` and season, for games that match a row of ``seasons``.

    Games are summed per player, team and season first: the join then sees a few rows per player
    however many games one player holds, and sums of sums are the same sums.
    """
    kept = list(dict.fromkeys([*dims, *join_keys]))
    partial = games.groupBy(*kept).agg(
        F.sum(_points()).alias("_points"), F.count("*").alias("_games")
    )
    season_side = seasons.select("player_name", "season")
    if "season" not in join_keys:
        partial = partial.drop("season") if "season" in partial.columns else partial
    return partial.join(season_side, list(join_keys))


def grouping_sets_points(
    games: DataFrame,
    seasons: DataFrame,
    join_keys: Sequence[str] = ("player_name", "season"),
) -> DataFrame:
    """Points and games by (player, team), (player, season) and (team) in one pass.

    ``join_keys`` = ("player_name",) repeats every game for each season of the player.
    """
    base = _season_points(games, seasons, join_keys, ("player_name", "team_abbreviation"))
    player, team, season = F.col("player_name"), F.col("team_abbreviation"), F.col("season")

    def label(column: str, everything: str) -> Column:
        return (
            F.when(F.grouping(column) == 1, everything)
            .otherwise(F.col(column).cast("string"))
        )

    totals = base.groupingSets(
        [[player, team], [player, season], [team]], player, team, season
    ).agg(
        F.sum("_points").alias("total_points"),
        F.sum("_games").alias("games_played"),
        label("player_name", "ALL_PLAYERS").alias("player_label"),
        label("team_abbreviation", "ALL_TEAMS").alias("team_label"),
        label("season", "ALL_SEASONS").alias("season_label"),
    )
    return ordered_desc(totals, "total_points", "player_label", "team_label", "season_label")


def top_player_for_team(games: DataFrame) -> DataFrame:
    """Most points one player scored for one team, ties kept."""
    totals = games.groupBy("player_name", "team_abbreviation").agg(
        F.sum(_points()).alias("total_points")
    )
    return top_with_ties(totals, "total_points")


def top_player_season(
    games: DataFrame,
    seasons: DataFrame,
    join_keys: Sequence[str] = ("player_name", "season"),
) -> DataFrame:
    """Most points one player scored in one season, ties kept."""
    totals = (
        _season_points(games, seasons, join_keys, ("player_name",))
        .groupBy("player_name", "season")
        .agg(F.sum("_points").alias("total_points"))
    )
    return top_with_ties(totals, "total_points")


def team_game_outcomes(games: DataFrame) -> DataFrame:
    """Per team and game: opponents met and opponents beaten.

    Beating an opponent means strictly more points.  Among the teams of one game, the opponents
    with fewer points are the rows before the first row of equal points, which is rank() - 1: no
    pair of teams is ever formed.  Games with a single team and rows without a team drop out.
    """
    points = (
        games.filter(F.col("team_abbreviation").isNotNull() & F.col("game_id").isNotNull())
        .groupBy("team_abbreviation", "game_id")
        .agg(F.sum(_points()).alias("_team_points"))
    )
    game = Window.partitionBy("game_id")
    return (
        points.select(
            "team_abbreviation",
            "game_id",
            (F.rank().over(game.orderBy("_team_points")) - 1).cast("bigint").alias("wins"),
            (F.count("*").over(game) - 1).alias("opponents"),
        )
        .filter("opponents > 0")
    )


def team_wins(games: DataFrame) -> DataFrame:
    """Wins per team over all its opponents."""
    totals = (
        team_game_outcomes(games)
        .groupBy("team_abbreviation")
        .agg(F.sum("wins").alias("total_wins"))
    )
    return ordered_desc(totals, "total_wins", "team_abbreviation")


def top_team_wins(games: DataFrame) -> DataFrame:
    """The team (or tied teams) with most wins."""
    return top_with_ties(
        team_game_outcomes(games)
        .groupBy("team_abbreviation")
        .agg(F.sum("wins").alias("total_wins")),
        "total_wins",
    )


def max_wins_in_stretch(
    games: DataFrame,
    stretch: int = 90,
    order: str = "game_id",
    slots: int | Column = SLOT_WIDTH,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Most wins of each team in any ``stretch`` consecutive games (shorter starts count).

    There are few teams, so the games of a team are summed by slots of ``order`` and blocks of rows.
    Games are taken as two-sided: one row, and at most one win, per team and game.
    """
    outcomes = team_game_outcomes(games)
    rolled = rolling_sum(
        outcomes, ["team_abbreviation"], order, F.col("wins"), stretch, "_wins", slots, block_rows=block_rows
    )
    best = rolled.groupBy("team_abbreviation").agg(
        F.max("_wins").alias(f"max_wins_in_{stretch}_games")
    )
    return ordered_desc(best, f"max_wins_in_{stretch}_games", "team_abbreviation")


def longest_streak(
    games: DataFrame,
    predicate: Column | None = None,
    entity: str = "player_name",
    order: str = "game_id",
    slots: int | Column = SLOT_WIDTH,
    names: tuple[str, str, str] = (
        "games_in_row_over_10",
        "streak_start_game",
        "streak_end_game",
    ),
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Longest run of consecutive games per entity for which ``predicate`` holds, ties kept.

    A row that fails (or is NULL) breaks the run, so a run is the set of hits with the same number
    of breaks before them.  Breaks are numbered inside each slot of ``order`` first, and hits are counted by that
    number; the pieces of runs, not the games, then meet the breaks of the earlier slots.
    """
    hit = F.coalesce(predicate if predicate is not None else F.col("pts") > 10, F.lit(False))
    slotted = games.filter(F.col(entity).isNotNull()).select(
        entity, *dict.fromkeys([order, *tie_break]), hit.alias("_hit"), slot_of(games, order, slots).alias("_slot")
    )
    breaks = F.when(F.col("_hit"), 0).otherwise(1)
    inside = Window.partitionBy(entity, "_slot").orderBy(*[F.col(c).asc_nulls_first() for c in (order, *tie_break)])
    pieces = (
        slotted.withColumn("_local", F.sum(breaks).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("_hit")
        .groupBy(entity, "_slot", "_local")
        .agg(F.count("*").alias("_n"), F.min(order).alias("_first"), F.max(order).alias("_last"))
    )
    runs = (
        with_offsets(pieces, slot_offsets(slotted, [entity], {"breaks": breaks}), [entity])
        .groupBy(entity, (F.col("_local") + F.col("_before_breaks")).alias("_breaks"))
        .agg(
            F.sum("_n").alias(names[0]),
            F.min("_first").alias(names[1]),
            F.max("_last").alias(names[2]),
        )
    )
    return top_with_ties(runs, names[0], [entity]).select(entity, *names)
