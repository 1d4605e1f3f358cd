"""Match statistics: the denormalised match fact, bucketed joins and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import whole_number
from .relational import checked_broadcast, ordered_desc


def _kills(column: str = "player_total_kills") -> Column:
    """Kills as a number; text that is not a number becomes NULL."""
    return whole_number(F.col(column))


def with_completion_day(matches: DataFrame) -> DataFrame:
    """Cut ``completion_date`` to the start of its day."""
    return matches.withColumn("completion_date", F.date_trunc("day", "completion_date"))


def match_fact(
    match_details: DataFrame,
    matches: DataFrame,
    medals_matches_players: DataFrame,
    medals: DataFrame,
    maps: DataFrame,
    partitions: int | None = None,
) -> DataFrame:
    """Match x player x medal rows with playlist, map and medal names (all players kept).

    Medals join first, on match and player, which spreads a match with very many rows over its
    players; adaptive execution splits it for the join with its one row in ``matches``.  The two
    name tables are broadcast after a size check.  ``partitions`` places the large tables by match
    beforehand, which pays only if they are reused; by default Spark chooses.
    """
    if partitions:
        match_details, matches, medals_matches_players = [
            t.repartition(partitions, "match_id")
            for t in (match_details, matches, medals_matches_players)
        ]
    details = match_details.select("match_id", "player_gamertag", _kills().alias("kills"))
    match_side = matches.select("match_id", "playlist_id", F.col("mapid").alias("_mapid"))
    earned = medals_matches_players.select("match_id", "player_gamertag", "medal_id")
    medal_names = medals.select("medal_id", F.col("name").alias("medal_name"))
    map_names = maps.select(F.col("mapid").alias("mapid"), F.col("name").alias("map_name"))
    return (
        details.join(earned, ["match_id", "player_gamertag"], "left")
        .join(match_side, "match_id", "left")
        .join(checked_broadcast(medal_names), "medal_id", "left")
        .join(checked_broadcast(map_names), F.col("_mapid") == F.col("mapid"), "left")
        .select(
            "match_id",
            "player_gamertag",
            "kills",
            "playlist_id",
            "mapid",
            "map_name",
            "medal_name",
        )
    )


def bucketed_match_join(
    details: DataFrame,
    matches: DataFrame,
    earned: DataFrame,
    player_keys: Sequence[str] = ("player_gamertag",),
) -> DataFrame:
    """Inner join of three tables bucketed on ``match_id``; open them in ``bucket_join_session``
    and no side is shuffled.

    A bucket is read by one task, so this suits tables whose matches are of similar size; with a
    match of extreme size use :func:`match_fact`.  Medals belong to the player that earned them.
    ``player_keys=()`` joins on the match alone, which pairs every player of a match with every
    medal of the match.
    """
    medal_side = earned
    if not player_keys:
        medal_side = earned.withColumnRenamed("player_gamertag", "medal_player_gamertag")
    return (
        details.join(matches.hint("merge"), "match_id")
        .join(medal_side.hint("merge"), ["match_id", *player_keys])
    )


def hot_match_join(
    details: DataFrame,
    hot_details: DataFrame,
    matches: DataFrame,
    hot_matches: DataFrame,
    earned: DataFrame,
    hot_earned: DataFrame,
) -> DataFrame:
    """The bucketed join of tables whose hot matches were kept apart (``write_bucketed_hot``), without a shuffle.

    Cold matches join from buckets on the match.  The players of a hot match lie spread over all buckets, in both
    large tables alike, and the few hot rows of ``matches`` are copied to every task.  Open the tables in
    ``bucket_join_session``.
    """
    named = hot_matches.where(F.col("match_id").isNotNull())
    crowded = hot_details.hint("merge").join(hot_earned.hint("merge"), ["match_id", "player_gamertag"])
    hot = crowded.join(checked_broadcast(named), "match_id")
    cold = bucketed_match_join(details, matches, earned)
    return cold.unionByName(hot.select(*cold.columns))


def avg_kills_per_game(match_details: DataFrame) -> DataFrame:
    """Kills per distinct match of each player, best first."""
    per_player = match_details.groupBy("player_gamertag").agg(
        (F.sum(_kills()) / F.count_distinct("match_id")).alias("avg_kills_per_game")
    )
    return ordered_desc(per_player, "avg_kills_per_game", "player_gamertag")


def most_played_playlist(matches: DataFrame) -> DataFrame:
    per_playlist = matches.groupBy("playlist_id").agg(
        F.count_distinct("match_id").alias("total_matches")
    )
    return ordered_desc(per_playlist, "total_matches", "playlist_id")


def _map_names(maps: DataFrame) -> DataFrame:
    names = maps.select(F.col("mapid").alias("_known_mapid"), F.col("name").alias("map_name"))
    return checked_broadcast(names)


def most_played_map(matches: DataFrame, maps: DataFrame) -> DataFrame:
    """Distinct matches per map; matches on unknown maps share one NULL row."""
    named = matches.select("match_id", "mapid").join(
        _map_names(maps), F.col("mapid") == F.col("_known_mapid"), "left"
    )
    per_map = named.groupBy(F.col("_known_mapid").alias("mapid"), "map_name").agg(
        F.count_distinct("match_id").alias("total_plays")
    )
    return ordered_desc(per_map, "total_plays", "mapid", "map_name")


# Fixed value: the medal the report asks for.
DEFAULT_MEDAL = "Killing Spree"


def medal_maps(
    medals_matches_players: DataFrame,
    medals: DataFrame,
    matches: DataFrame,
    maps: DataFrame,
    medal_name: str = DEFAULT_MEDAL,
    weight_col: str | None = None,
) -> DataFrame:
    """Rows with a medal per map (or the sum of ``weight_col``), unknown maps as NULL.

    Rows are counted per match before they meet ``matches``, so a match with very many medals
    enters the join as one row.
    """
    wanted = medals.filter(F.col("name") == medal_name).select("medal_id")
    weight = F.col(weight_col) if weight_col else F.lit(1)
    per_match = (
        medals_matches_players.join(checked_broadcast(wanted), "medal_id")
        .groupBy("match_id")
        .agg(F.sum(weight).cast("bigint").alias("_rows"))
    )
    named = per_match.join(matches.select("match_id", "mapid"), "match_id", "left").join(
        _map_names(maps), F.col("mapid") == F.col("_known_mapid"), "left"
    )
    per_map = named.groupBy(F.col("_known_mapid").alias("mapid"), "map_name").agg(
        F.sum("_rows").alias("medal_count")
    )
    return ordered_desc(per_map, "medal_count", "mapid", "map_name")
