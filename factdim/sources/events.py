"""Web events as JSON lines or as message values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import whole_number

# ``ts`` is read as text so that 1697059200000 and "1697059200000" are both accepted.
_RAW = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def _required() -> Column:
    present = F.col("ip").isNotNull() & F.col("host").isNotNull()
    return present & whole_number(F.col("ts"), "bigint").isNotNull()


def _typed(raw: DataFrame) -> DataFrame:
    return raw.filter(_required()).select(
        *[c for c in raw.columns if c not in _RAW.fieldNames()],
        "ip",
        "host",
        whole_number(F.col("ts"), "bigint").alias("ts"),
        F.coalesce("path", F.lit("")).alias("path"),
    )


def read_web_events(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    rejects: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """JSON-lines events ``{ip, host, ts (epoch ms), path}``; blank lines are skipped.

    A missing path is "".  ``rejects=True`` returns the lines without ip, host or usable ts
    (malformed JSON included) instead, as they were read.  A stream takes at most ``files_per_batch`` files or
    about ``bytes_per_batch`` (such as "1g") in a micro-batch; name one of the two.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if streaming and bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    raw = reader.schema(_RAW).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return raw.filter(~_required()) if rejects else _typed(raw)


def decode_web_events(
    messages: DataFrame, value_col: str = "value", rejects: bool = False
) -> DataFrame:
    """Events from message values (text or bytes holding one JSON object each).

    Works on any source with such a column, for example a topic read with
    ``spark.readStream.format("kafka")``.
    """
    parsed = messages.select(
        F.from_json(
            F.col(value_col).cast("string"), _RAW, {"columnNameOfCorruptRecord": "_corrupt"}
        ).alias("_e"),
    ).select("_e.*")
    return parsed.filter(~_required()) if rejects else _typed(parsed)


def parse_web_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Every message with its fields and, where it is no event, the ``reason``.

    All columns of ``messages`` stay (key, partition, offset, ...), the value as text in ``value``; ip, host,
    ts and path are added, NULL where there is none (a missing path of an event is "").
    """
    others = [c for c in messages.columns if c not in (value_col, "ip", "host", "ts", "path", "value", "reason")]
    parsed = messages.select(*others, F.col(value_col).cast("string").alias("value")).withColumn(
        "_e", F.from_json("value", _RAW, {"columnNameOfCorruptRecord": "_corrupt"})
    )
    event, ts = F.col("_e"), whole_number(F.col("_e.ts"), "bigint")
    reason = (
        F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty")
        .when(event.isNull() | event["_corrupt"].isNotNull(), "malformed")
        .when(event["ip"].isNull(), "no ip")
        .when(event["host"].isNull(), "no host")
        .when(ts.isNull(), "no ts")
    )
    return parsed.select(
        *others,
        "value",
        event["ip"].alias("ip"),
        event["host"].alias("host"),
        ts.alias("ts"),
        F.when(reason.isNull(), F.coalesce(event["path"], F.lit(""))).alias("path"),
        reason.alias("reason"),
    )
