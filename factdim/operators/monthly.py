"""Monthly reduced facts: one row per key and month with one array slot per day."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fit_to, on_day


def daily_activity(
    events: DataFrame,
    keys: Sequence[str],
    ts_col: str = "event_time",
    visitor: str = "user_id",
) -> DataFrame:
    """Hits and distinct visitors per key and day; NULL keys and visitors are left out.

    Spark first reduces to (key, day, visitor), so a hot key is spread over its visitors.
    """
    columns = dict.fromkeys([*keys, visitor])
    return (
        events.dropna(subset=list(columns))
        .groupBy(*keys, F.to_date(ts_col).alias("date"))
        .agg(F.count("*").alias("hits"), F.count_distinct(F.col(visitor)).alias("visitors"))
    )


def monthly_array_increment(
    prev: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    date: dt.date,
    ts_col: str = "event_time",
    visitor: str = "user_id",
) -> DataFrame:
    """Month rows after ``date``: slots 1..day-1 from ``prev``, slot day from the day's events.

    Slots are addressed by day, so a missed day leaves zeros and a repeated day is replaced.
    """
    keys = list(keys)
    month = date.replace(day=1)
    before = prev.filter(F.col("month") == month).select(*keys, "hit_array", "unique_visitors")
    today = daily_activity(events.filter(on_day(F.col(ts_col), date)), keys, ts_col, visitor)

    def slots(old: str, new: str):
        return F.concat(
            fit_to(F.col(old), date.day - 1), F.array(F.coalesce(F.col(new), F.lit(0)).cast("bigint"))
        ).alias(old)

    return before.join(today.drop("date"), keys, "full").select(
        *keys,
        F.lit(month).alias("month"),
        slots("hit_array", "hits"),
        slots("unique_visitors", "visitors"),
    )


def monthly_array_backfill(
    events: DataFrame,
    keys: Sequence[str],
    month: dt.date,
    end: dt.date | None = None,
    ts_col: str = "event_time",
    visitor: str = "user_id",
) -> DataFrame:
    """Month rows up to ``end`` (default: the whole month) in one pass."""
    first = month.replace(day=1)
    if end is None:
        end = first.replace(day=calendar.monthrange(first.year, first.month)[1])
    in_range = (F.col(ts_col) >= F.lit(first)) & (F.col(ts_col) < F.lit(end + dt.timedelta(days=1)))
    daily = daily_activity(events.filter(in_range), keys, ts_col, visitor)
    slot = F.struct(F.dayofmonth("date"), F.struct("hits", "visitors"))
    by_day = daily.groupBy(*keys).agg(F.map_from_entries(F.collect_list(slot)).alias("_days"))

    def slots(value: str, name: str):
        filled = F.transform(
            F.sequence(F.lit(1), F.lit(end.day)),
            lambda day: F.coalesce(F.col("_days")[day][value], F.lit(0).cast("bigint")),
        )
        return filled.alias(name)

    return by_day.select(
        *keys,
        F.lit(first).alias("month"),
        slots("hits", "hit_array"),
        slots("visitors", "unique_visitors"),
    )


def monthly_array_explode(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Back to one row per key and day."""
    zipped = F.arrays_zip("hit_array", "unique_visitors")
    return df.select(*keys, "month", F.posexplode(zipped).alias("_day", "_slot")).select(
        *keys,
        F.date_add("month", F.col("_day")).alias("date"),
        F.col("_slot.hit_array").alias("hits"),
        F.col("_slot.unique_visitors").alias("visitors"),
    )


def monthly_array_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hits and visitors of the month per key straight from the arrays, without exploding them."""

    def total(name: str):
        return F.aggregate(F.col(name), F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    return df.select(
        *keys, "month", total("hit_array").alias("hits"), total("unique_visitors").alias("visitors")
    )
