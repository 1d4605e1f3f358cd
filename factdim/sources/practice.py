"""The practice tables (orders, lineitem, events, ...) as the tables the operators work on."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import to_epoch_ms
from ..operators.matches import DEFAULT_MEDAL

HOSTS = ("news.example.org", "www.example.org", "shop.example.org")
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge")


def _choice(number, options):
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


# Schemas seen so far: reading a known table again needs no look at its files.
_SCHEMAS: dict[str, T.StructType] = {}


class Practice:
    """Views over one folder of practice tables; every view is a lazy projection of a scan."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # --- the periods the tables reach -------------------------------------------------------

    @cached_property
    def last_year(self) -> int:
        return self.table("orders").agg(F.max(F.year("o_orderdate"))).first()[0]

    @cached_property
    def _days(self) -> tuple[dt.date, dt.date]:
        return tuple(self.table("events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first())

    @property
    def first_day(self) -> dt.date:
        return self._days[0]

    @property
    def last_day(self) -> dt.date:
        return self._days[1]

    # --- dimensional modelling -----------------------------------------------------------

    def actor_films(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.table("orders").select(
            F.concat(F.lit("Customer#"), "o_custkey").alias("actor"),
            F.col("o_custkey").cast("string").alias("actorid"),
            F.col("o_orderpriority").alias("film"),
            F.year("o_orderdate").alias("year"),
            F.floor(price).cast("int").alias("votes"),
            (F.floor(price / 50000) + 1).cast("int").alias("rating"),
            F.col("o_orderkey").cast("string").alias("filmid"),
        )

    # --- games ---------------------------------------------------------------------------

    def players(self) -> DataFrame:
        return self.table("customer").select(
            F.concat(F.lit("Player#"), "c_custkey").alias("player_name")
        )

    def player_seasons(self) -> DataFrame:
        return (
            self.table("orders")
            .select(
                F.concat(F.lit("Player#"), "o_custkey").alias("player_name"),
                F.year("o_orderdate").alias("season"),
            )
            .distinct()
        )

    def game_details(self, two_teams: bool = False) -> DataFrame:
        season = F.year("l_shipdate")
        if two_teams:
            step = F.lit(1) + F.floor(F.col("l_orderkey") / 30) % 29
            team = (F.col("l_orderkey") + (F.col("l_linenumber") % 2) * step) % 30
        else:
            team = (F.col("l_suppkey") + season) % 30
        no_points = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("game_id"),
            team.cast("int").alias("team_id"),
            F.col("l_suppkey").alias("player_id"),
            F.concat(F.lit("Player#"), "l_suppkey").alias("player_name"),
            F.concat(F.lit("T"), team.cast("int")).alias("team_abbreviation"),
            season.alias("season"),
            F.when(~no_points, F.col("l_quantity").cast("int")).alias("pts"),
        )

    # --- site activity -------------------------------------------------------------------

    def _device(self):
        return F.get_json_object("props", "$.k").cast("bigint")

    def site_events(self) -> DataFrame:
        return self.table("events").select(
            "user_id",
            self._device().alias("device_id"),
            _choice(F.col("user_id"), HOSTS).alias("host"),
            F.col("ts").alias("event_time"),
        )

    def devices(self) -> DataFrame:
        device = F.col("device_id")
        return (
            self.table("events")
            .select(self._device().alias("device_id"))
            .distinct()
            .select(device, _choice(device, BROWSERS).alias("browser_type"))
        )

    def device_days(self) -> DataFrame:
        """Days on which a user was seen on a browser: (user_id, browser_type, event_time).

        Events are reduced to (user, device, day) before they meet the devices; the join drops
        events without a device.
        """
        seen = (
            self.site_events()
            .dropna(subset=["user_id"])
            .select("user_id", "device_id", F.to_date("event_time").alias("event_time"))
            .distinct()
        )
        return seen.join(self.devices(), "device_id").select(
            F.col("user_id").cast("string").alias("user_id"), "browser_type", "event_time"
        )

    def web_events(self, events: DataFrame | None = None, *others: str) -> DataFrame:
        source = self.table("events") if events is None else events
        return source.select(
            *others,
            F.concat(F.lit("10.0.0."), F.col("user_id") % 5).alias("ip"),
            _choice(F.col("user_id"), HOSTS).alias("host"),
            to_epoch_ms(F.col("ts")).alias("ts"),
            F.col("event_type").alias("path"),
        )

    def web_event_stream(self) -> DataFrame:
        schema = self.table("events").schema
        stored = self.spark.readStream.schema(schema).parquet(f"{self.folder}/events.parquet*")
        return self.web_events(stored)

    def day_slice(self, of: int):
        """Number of an equal slice of the days of the events, 0 to ``of`` - 1."""
        day = F.to_date("ts")
        span = self.table("events").select(F.min(day).alias("a"), F.max(day).alias("b"))
        first, last = span.select("a").scalar(), span.select("b").scalar()
        number = F.datediff(day, first) * of / (F.datediff(last, first) + 1)
        return F.floor(number).cast("int")

    def web_event_lines(self, slices: int = 5) -> DataFrame:
        """The web events as JSON text ``value``, with the ``slice`` of time in which a line arrives.

        Of 40 events one is cut short, one lacks its ip, one has no usable time, and one comes a slice late.
        """
        case = F.col("event_id") % 40
        events = self.table("events").withColumns({"_case": case, "slice": self.day_slice(slices)})
        moves = (case == 4) & (F.col("slice") < slices - 1)
        events = events.withColumn("slice", F.when(moves, F.col("slice") + 1).otherwise(F.col("slice")))
        web = self.web_events(events, "_case", "slice")
        line = F.to_json(F.struct("ip", "host", "ts", "path"))
        value = (
            F.when(F.col("_case") == 1, F.substring(line, 1, 20))
            .when(F.col("_case") == 2, F.to_json(F.struct("host", "ts", "path")))
            .when(F.col("_case") == 3, F.to_json(F.struct("ip", "host", F.lit("soon").alias("ts"), "path")))
            .otherwise(line)
        )
        return web.select(value.alias("value"), "slice")

    # --- matches -------------------------------------------------------------------------

    def match_details(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("match_id"),
            F.col("l_suppkey").cast("string").alias("player_gamertag"),
            F.col("l_quantity").cast("int").cast("string").alias("player_total_kills"),
        )

    def matches(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("match_id"),
            (F.col("o_custkey") % 28).cast("string").alias("mapid"),
            F.col("o_orderpriority").alias("playlist_id"),
            F.col("o_orderdate").alias("completion_date"),
        )

    def medals_matches_players(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("match_id"),
            F.col("l_suppkey").cast("string").alias("player_gamertag"),
            F.col("l_partkey").cast("string").alias("medal_id"),
        )

    def crowded(self, table: DataFrame) -> DataFrame:
        """A table with matches in which every third match is part of the match 'final', whose players keep apart.

        Of the rows of ``matches`` that would be one the first stays.
        """
        number = F.col("match_id").cast("bigint")
        final = number % 3 == 0
        if "player_gamertag" in table.columns:
            player = F.concat("player_gamertag", F.lit("-"), "match_id")
            table = table.withColumn("player_gamertag", F.when(final, player).otherwise(F.col("player_gamertag")))
        else:
            first = table.where(final).select(F.min(number)).scalar()
            table = table.where(~final | (number == first))
        return table.withColumn("match_id", F.when(final, "final").otherwise(F.col("match_id")))

    def medals(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("medal_id"),
            F.when(F.col("p_size") == 7, DEFAULT_MEDAL).otherwise(F.col("p_name")).alias("name"),
        )

    def maps(self) -> DataFrame:
        """Matches also name maps 25 to 27, which are unknown here."""
        return self.table("nation").select(
            F.col("n_nationkey").cast("string").alias("mapid"), F.col("n_name").alias("name")
        )
