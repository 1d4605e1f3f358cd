"""Data checks behind pipeline alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import whole_number


def _with_absent_days(daily: DataFrame, date_col: str, value_col: str, keys: Sequence[str], value) -> DataFrame:
    """``daily`` with a row of ``value`` for every day a key misses, up to the last day of the table.

    The rows come from the gap to the next present day, so only absent days are generated.
    """
    last = daily.select(F.max(date_col)).scalar()
    following = F.lead(date_col).over(Window.partitionBy(*keys).orderBy(date_col))
    until = F.coalesce(F.date_sub(following, 1), last)
    days = F.sequence(F.col(date_col), F.col("_until"), F.expr("interval 1 day"))
    return (
        daily.filter(F.col(date_col).isNotNull())
        .withColumn("_until", until)
        .withColumn("_day", F.explode(days))
        .withColumn(value_col, F.when(F.col("_day") == F.col(date_col), F.col(value_col)).otherwise(F.lit(value)))
        .withColumn(date_col, F.col("_day"))
        .drop("_until", "_day")
    )


def consecutive_drop_alert(
    daily: DataFrame,
    date_col: str = "date",
    value_col: str = "value",
    pct: float = 0.2,
    days: int = 2,
    keys: Sequence[str] = (),
    absent: float | None = 0,
) -> DataFrame:
    """Days on which the value fell by ``pct`` or more for the ``days``-th day in a row.

    ``daily`` is a series, one row per key and day.  A missing day counts as ``absent``, also after the
    last row of a key; with None it interrupts the count instead.  A value that stays at 0 does not fall.
    """
    if absent is not None:
        daily = _with_absent_days(daily, date_col, value_col, keys, absent)
    w = Window.partitionBy(*keys).orderBy(date_col)
    previous = F.when(F.datediff(date_col, F.lag(date_col).over(w)) == 1, F.lag(value_col).over(w))
    dropped = daily.withColumn("_previous", previous).withColumn(
        "_drop",
        F.coalesce(
            (F.col("_previous") > F.col(value_col))
            & ((F.col("_previous") - F.col(value_col)) >= F.lit(pct) * F.col("_previous")),
            F.lit(False),
        ),
    )
    recent = F.sum(F.when(F.col("_drop"), 1).otherwise(0)).over(w.rowsBetween(-(days - 1), 0))
    return (
        dropped.withColumn("_in_row", recent)
        .filter(F.col("_in_row") == days)
        .select(*keys, date_col, value_col, F.col("_previous").alias("previous_value"))
    )


def missing_periods(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dates between the first and the last date (per key) that have no row.

    Found from the gap to the next present date; only missing dates are ever generated.
    """
    present = df.select(*keys, F.to_date(date_col).alias("_date")).dropna().distinct()
    following = F.lead("_date").over(Window.partitionBy(*keys).orderBy("_date"))
    return (
        present.withColumn("_next", following)
        .filter(F.datediff("_next", "_date") > 1)
        .select(
            *keys,
            F.explode(
                F.sequence(F.date_add("_date", 1), F.date_sub("_next", 1), F.expr("interval 1 day"))
            ).alias("missing_date"),
        )
    )


def volume_drop(
    df: DataFrame, ts_col: str, window: int = 7, ratio: float = 0.8, keys: Sequence[str] = ()
) -> DataFrame:
    """Days whose row count is below ``ratio`` x the mean of the previous ``window`` days.

    From the first day of a key to the last day of the table, days without rows count 0.
    """
    daily = df.groupBy(*keys, F.to_date(ts_col).alias("date")).agg(F.count("*").alias("rows"))
    daily = _with_absent_days(daily, "date", "rows", keys, 0)
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(-window, -1)
    return (
        daily.withColumn("trailing_mean", F.avg("rows").over(w))
        .filter(F.col("rows") < F.lit(ratio) * F.col("trailing_mean"))
        .select(*keys, "date", "rows", "trailing_mean")
    )


def _try_cast(value: Column, actual: T.DataType, expected: T.DataType) -> Column:
    if isinstance(actual, T.StringType) and isinstance(expected, T.IntegralType):
        return whole_number(value, expected.simpleString())
    return value.try_cast(expected)


def schema_conformance(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Per expected column: present, types, share of NULLs, share of values that do not cast.

    One aggregation over the data; columns that are not expected are listed with a NULL type.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggregates, report = [F.count("*").alias("_rows")], []

    def share(name: str):
        return F.when(F.col("_rows") > 0, F.col(name) / F.col("_rows"))

    for i, field in enumerate(expected.fields):
        found = field.name in actual
        if found:
            value = F.col(f"`{field.name}`")
            cast = _try_cast(value, actual[field.name], field.dataType)
            aggregates += [
                F.count_if(value.isNull()).alias(f"_null{i}"),
                F.count_if(value.isNotNull() & cast.isNull()).alias(f"_bad{i}"),
            ]
        report.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(found).alias("present"),
                F.lit(field.dataType.simpleString()).alias("expected_type"),
                F.lit(actual[field.name].simpleString() if found else None)
                .cast("string")
                .alias("actual_type"),
                (share(f"_null{i}") if found else F.lit(None)).cast("double").alias("null_rate"),
                (share(f"_bad{i}") if found else F.lit(None)).cast("double").alias("bad_cast_rate"),
            )
        )
    for name in [c for c in df.columns if c not in expected.fieldNames()]:
        report.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(True).alias("present"),
                F.lit(None).cast("string").alias("expected_type"),
                F.lit(actual[name].simpleString()).alias("actual_type"),
                F.lit(None).cast("double").alias("null_rate"),
                F.lit(None).cast("double").alias("bad_cast_rate"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*report)))


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime) -> DataFrame:
    """Newest timestamp of each table and its age in minutes at ``as_of`` (UTC)."""
    reports = []
    for name, (df, ts_col) in tables.items():
        newest = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("latest"))
        age_ms = F.lit(int(as_of.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)) - F.unix_millis("latest")
        reports.append(
            newest.select(
                F.lit(name).alias("table_name"),
                "latest",
                F.floor(age_ms / 60_000).cast("bigint").alias("lag_minutes"),
            )
        )
    first, *others = reports
    for other in others:
        first = first.unionByName(other)
    return first
