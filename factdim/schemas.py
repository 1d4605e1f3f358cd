"""Table definitions: column types, keys and the quality domain."""

from __future__ import annotations

from pyspark.sql import types as T

# The quality classes from lowest to highest, and the lowest average rating
# of each class above "bad".
QUALITY = ("bad", "average", "good", "star")
QUALITY_FLOORS = {"average": 6, "good": 7, "star": 8}

FILM_STATS = T.StructType(
    [
        T.StructField("film", T.StringType()),
        T.StructField("votes", T.IntegerType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("filmid", T.StringType()),
    ]
)

SCD_RUN = T.StructType(
    [
        T.StructField("quality_class", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("start_year", T.IntegerType()),
        T.StructField("end_year", T.IntegerType()),
    ]
)

ACTOR_FILMS = T.StructType(
    [
        T.StructField("actor", T.StringType()),
        T.StructField("actorid", T.StringType()),
        T.StructField("film", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("votes", T.IntegerType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("filmid", T.StringType()),
    ]
)

ACTORS = T.StructType(
    [
        T.StructField("actor", T.StringType()),
        T.StructField("actorid", T.StringType()),
        T.StructField("films", T.ArrayType(FILM_STATS)),
        T.StructField("quality_class", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("current_year", T.IntegerType()),
    ]
)

ACTORS_HISTORY_SCD = T.StructType(
    [T.StructField("actorid", T.StringType()), T.StructField("actor", T.StringType())]
    + SCD_RUN.fields
    + [T.StructField("current_year", T.IntegerType())]
)

USER_DEVICES_CUMULATED = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("browser_type", T.StringType()),
        T.StructField("device_activity_datelist", T.ArrayType(T.DateType())),
        T.StructField("date", T.DateType()),
    ]
)

HOSTS_CUMULATED = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("host_activity_datelist", T.ArrayType(T.DateType())),
        T.StructField("date", T.DateType()),
    ]
)

HOST_ACTIVITY_REDUCED = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("host", T.StringType()),
        T.StructField("hit_array", T.ArrayType(T.LongType())),
        T.StructField("unique_visitors", T.ArrayType(T.LongType())),
    ]
)

MATCH_DETAILS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("player_gamertag", T.StringType()),
        T.StructField("player_total_kills", T.StringType()),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("mapid", T.StringType()),
        T.StructField("playlist_id", T.StringType()),
        T.StructField("completion_date", T.TimestampType()),
    ]
)

MEDALS_MATCHES_PLAYERS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("player_gamertag", T.StringType()),
        T.StructField("medal_id", T.StringType()),
    ]
)

MEDALS = T.StructType(
    [T.StructField("medal_id", T.StringType()), T.StructField("name", T.StringType())]
)

MAPS = T.StructType(
    [T.StructField("mapid", T.StringType()), T.StructField("name", T.StringType())]
)

WEB_EVENTS = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)

SESSIONIZED_EVENTS = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("session_start", T.TimestampType()),
        T.StructField("session_end", T.TimestampType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("session_id", T.StringType()),
    ]
)

# Primary keys; Spark does not enforce them, see operators.relational.assert_unique_key.
KEYS = {
    "actor_films": ("actorid", "filmid"),
    "actors": ("actorid", "current_year"),
    "actors_history_scd": ("actorid", "start_year", "current_year"),
    "user_devices_cumulated": ("user_id", "date", "browser_type"),
    "hosts_cumulated": ("user_id", "date", "host"),
    "host_activity_reduced": ("user_id", "month", "host"),
    "sessionized_events": ("host", "ip", "session_start"),
}
