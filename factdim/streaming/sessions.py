"""Continuous event-time sessions with a replay-safe sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import from_epoch_ms, session_id
from ..operators.relational import dedup
from ..schemas import KEYS
from .keyed_table import KeyedTable

# How far events may be out of order, the session gap, rows per database batch.
OUT_OF_ORDER = "10 seconds"
SESSION_GAP = "5 minutes"
SINK_BATCH_ROWS = 100

# State lives in RocksDB on the executors' disks, and a batch uploads what it changed: open sessions may
# outgrow the executors' memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sessionize_stream(
    events: DataFrame,
    keys: Sequence[str] = ("ip", "host"),
    ts_ms: str = "ts",
    gap: str = SESSION_GAP,
    delay: str = OUT_OF_ORDER,
) -> DataFrame:
    """Sessions per key of a stream of events; a session is emitted once, when it is closed.

    Events whose own gap lies wholly before the watermark are dropped.  State is one row per open
    session, so a hot key costs no more state than any other.
    """
    keys = list(keys)
    timed = (
        events.dropna(subset=[*keys, ts_ms])
        .withColumn("_time", from_epoch_ms(F.col(ts_ms)))
        .withWatermark("_time", delay)
    )
    sessions = timed.groupBy(*keys, F.session_window("_time", gap).alias("_window")).agg(
        F.count("*").alias("event_count")
    )
    start = F.col("_window.start")
    return sessions.select(
        *keys,
        start.alias("session_start"),
        F.col("_window.end").alias("session_end"),
        "event_count",
        session_id(F.col(keys[0]), F.concat_ws("|", *keys[1:]), F.unix_millis(start)).alias("session_id"),
    )


def foreach_batch_writer(
    target: str | Mapping[str, str],
) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: to a parquet folder, or by JDBC if ``target`` holds its options.

    Folder: each batch owns ``batch_id=<id>`` and overwrites it, so a replayed batch replaces its
    own rows.  JDBC: rows are appended with their ``batch_id``, ``SINK_BATCH_ROWS`` rows a statement; merge
    them on (host, ip, session_start) in the database.  For an upsert by key see :class:`KeyedTable`.
    """

    def to_folder(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    def to_jdbc(batch: DataFrame, batch_id: int) -> None:
        options = {"batchsize": str(SINK_BATCH_ROWS), **target}
        stamped = batch.withColumn("batch_id", F.lit(batch_id))
        stamped.write.format("jdbc").mode("append").options(**options).save()

    return to_folder if isinstance(target, str) else to_jdbc


def start_session_stream(
    sessions: DataFrame,
    target: str | Mapping[str, str] | KeyedTable,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 second",
) -> StreamingQuery:
    """Start writing sessions; a restart with the same ``checkpoint`` continues where it ended.

    The state store of ``STATE_CONF`` is set in the session of ``sessions``; a stream that was started with
    another one keeps it.  How much a micro-batch takes is the source's option (``read_web_events``).
    """
    for key, value in STATE_CONF.items():
        sessions.sparkSession.conf.set(key, value)
    write = target.upsert if isinstance(target, KeyedTable) else foreach_batch_writer(target)
    writer = (
        sessions.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def latest_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The written sessions with the newest batch winning per (host, ip, session_start)."""
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c != "batch_id"]
    return dedup(stored, KEYS["sessionized_events"], ["batch_id"], keep="last").select(*columns)


def session_table(spark: SparkSession, path: str) -> KeyedTable:
    """The sessions of a stream as a table with one row per (host, ip, session_start)."""
    return KeyedTable(spark, path, KEYS["sessionized_events"], "session_start")
