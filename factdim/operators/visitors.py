"""Distinct visitors that can be added up: bitmaps per key and day, merged into any coarser count.

A count of distinct visitors of a day cannot be summed to that of a week.  A bitmap of them can be merged, so that
weeks, months, trailing windows and totals over keys come from the stored days without the events.  Visitors are
whole numbers; a bitmap holds the 32 768 numbers of one ``bucket`` in 4 KB, and Spark merges bitmaps in every map
task, so that a hot key ships one bitmap per bucket and task, whatever its events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def visitor_bitmaps(
    events: DataFrame, keys: Sequence[str], ts_col: str = "event_time", visitor: str = "user_id"
) -> DataFrame:
    """The visitors of every key and day: keys, date, bucket, visitors (binary).

    Rows with a NULL key, time or visitor are left out.  A visitor that is no whole number is an error.
    """
    number = F.col(visitor).cast("bigint")
    return (
        events.dropna(subset=list(dict.fromkeys([*keys, ts_col, visitor])))
        .groupBy(*keys, F.to_date(ts_col).alias("date"), F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("visitors"))
    )


def count_visitors(bitmaps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Distinct visitors per ``by`` (columns of the bitmaps, or expressions of them): by, visitors.

    The bitmaps of a bucket are merged first; buckets share no visitor, so their counts add up.
    """
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("visitors")).alias("_n"))
    names = [c for c in merged.columns if c not in ("bucket", "_n")]
    return merged.groupBy(*names).agg(F.sum("_n").alias("visitors"))


def trailing_visitors(bitmaps: DataFrame, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct visitors of the ``days`` days up to each date: keys, date, visitors.

    A date counts from the first on which its window holds a visitor to the last date stored.  Days are merged per
    key first, so that a key's day goes into ``days`` windows as one bitmap a bucket.
    """
    last = bitmaps.select(F.max("date")).scalar()
    daily = bitmaps.groupBy(*keys, "date", "bucket").agg(F.bitmap_or_agg("visitors").alias("visitors"))
    reach = F.sequence(F.col("date"), F.date_add("date", days - 1))
    windows = daily.withColumn("date", F.explode(reach)).where(F.col("date") <= last)
    return count_visitors(windows, [*keys, "date"])
