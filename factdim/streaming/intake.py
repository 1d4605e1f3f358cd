"""Web events taken in from text lines or message values, with an account of every row.

A micro-batch is written once, each row to its outcome: ``accepted``, ``late`` (its session gap lies wholly before
the newest event of all earlier batches less the allowed delay) or ``rejected`` (with the reason).  A second, small
table keeps per batch how many rows went where and the newest event, which is the next batch's watermark.  A
replayed batch overwrites its own rows and account.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.events import parse_web_events

ACCOUNT = "batch_id long, accepted long, late long, rejected long, newest long"


def _milliseconds(interval: str) -> int:
    """An interval such as "5 minutes" in milliseconds."""
    number, unit = interval.split()
    return int(number) * {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]


def accounts(spark: SparkSession, target: str) -> DataFrame:
    """Rows accepted, late and rejected per batch, and the newest event (epoch ms) of the batch."""
    try:
        return spark.read.schema(ACCOUNT).option("recursiveFileLookup", "true").parquet(f"{target}/accounts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ACCOUNT)


def _taken_in(spark: SparkSession, target: str) -> DataFrame:
    """The rows of batches that have an account: a batch that crashed half way has none."""
    rows = spark.read.parquet(f"{target}/rows")
    return rows.join(F.broadcast(accounts(spark, target).select("batch_id")), "batch_id", "left_semi")


def accepted_events(spark: SparkSession, target: str) -> DataFrame:
    """Typed events: ip, host, ts, path and what else the source gave (message key, offset, ...)."""
    return _taken_in(spark, target).where(F.col("outcome") == "accepted").drop("outcome", "reason", "value", "batch_id")


def refused_events(spark: SparkSession, target: str) -> DataFrame:
    """Late and rejected rows as they came, with outcome, reason and batch."""
    return _taken_in(spark, target).where(F.col("outcome") != "accepted")


def take_in(batch: DataFrame, batch_id: int, target: str, value_col: str, gap_ms: int, delay_ms: int) -> None:
    """Write one micro-batch and its account."""
    spark = batch.sparkSession
    before = accounts(spark, target).where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
    watermark = None if before is None else before - delay_ms
    parsed = parse_web_events(batch, value_col)
    late: Column = F.lit(False) if watermark is None else F.col("ts") + gap_ms <= F.lit(watermark)
    outcome = F.when(F.col("reason").isNotNull(), "rejected").when(late, "late").otherwise("accepted")
    rows = f"{target}/rows/batch_id={batch_id}"
    parsed.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(rows)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in parsed.schema)}, outcome string"
    counted = spark.read.schema(schema).parquet(rows).agg(
        F.lit(batch_id).cast("long").alias("batch_id"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("accepted", "late", "rejected")],
        F.max(F.when(F.col("outcome") == "accepted", F.col("ts"))).alias("newest"),
    )
    counted.write.mode("overwrite").parquet(f"{target}/accounts/{batch_id}")


def start_intake(
    lines: DataFrame,
    target: str,
    checkpoint: str,
    value_col: str = "value",
    gap: str = "5 minutes",
    delay: str = "10 seconds",
    available_now: bool = False,
    every: str = "1 second",
) -> StreamingQuery:
    """Take in a stream of lines or messages; a restart with the same ``checkpoint`` continues where it ended."""
    gap_ms, delay_ms = _milliseconds(gap), _milliseconds(delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        take_in(batch, batch_id, target, value_col, gap_ms, delay_ms)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**trigger).start()
