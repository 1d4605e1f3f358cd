"""Event-time sessions over stored events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import session_id

# The session gap in minutes.
SESSION_GAP_MINUTES = 5


def sessionize(
    events: DataFrame,
    keys: Sequence[str] = ("ip", "host"),
    ts_ms: str = "ts",
    gap_ms: int = SESSION_GAP_MINUTES * 60_000,
) -> DataFrame:
    """Sessions per key: first event, last event + gap, event count and id.

    A new session starts when the distance to the previous event exceeds the gap; events exactly
    one gap apart stay together.  Two events in the same gap-wide slot of the time line always
    belong together, so events are first reduced to (min, max, count) per key and slot.  What is
    shuffled and sorted per key is then bounded by the time span, not by the events of the key.
    """
    keys = list(keys)
    ts = F.col(ts_ms)
    slots = (
        events.dropna(subset=[*keys, ts_ms])
        .groupBy(*keys, (ts - F.pmod(ts, F.lit(gap_ms))).alias("_slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_events"))
    )
    w = Window.partitionBy(*keys).orderBy("_slot")
    opens = F.col("_first") - F.lag("_last").over(w) > gap_ms
    numbered = slots.withColumn("_opens", F.when(opens, 1).otherwise(0)).withColumn(
        "_session", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    sessions = numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias("_start_ms"),
        (F.max("_last") + gap_ms).alias("_end_ms"),
        F.sum("_events").alias("event_count"),
    )
    return sessions.select(
        *keys,
        F.timestamp_millis("_start_ms").alias("session_start"),
        F.timestamp_millis("_end_ms").alias("session_end"),
        "event_count",
        session_id(F.col(keys[0]), F.concat_ws("|", *keys[1:]), F.col("_start_ms")).alias("session_id"),
    )


def session_stats(sessions: DataFrame, hosts: Sequence[str] = (), overall: str = "ALL") -> DataFrame:
    """Sessions and average events per session: one row over all ``hosts`` and one per host."""
    if hosts:
        sessions = sessions.filter(F.col("host").isin(*hosts))
    stats = sessions.groupingSets([[F.col("host")], []], F.col("host")).agg(
        F.grouping("host").alias("_all"),
        F.count("*").alias("sessions"),
        F.avg("event_count").alias("avg_events_per_session"),
    )
    return stats.select(
        F.when(F.col("_all") == 1, overall).otherwise(F.col("host")).alias("host"),
        "sessions",
        "avg_events_per_session",
    )
