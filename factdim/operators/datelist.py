"""Date lists as 32-day bitmasks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bit_text, day_bit, last_days_mask


def datelist_int(
    df: DataFrame,
    list_col: str,
    end_date: dt.date,
    keys: Sequence[str],
    width: int = 32,
) -> DataFrame:
    """Bitmask of the ``width`` days up to ``end_date`` (top bit = ``end_date``) and what it tells.

    Works on each row alone: no calendar join and no shuffle.
    """
    mask = F.aggregate(
        F.coalesce(F.col(list_col), F.array().cast("array<date>")),
        F.lit(0).cast("bigint"),
        lambda acc, day: acc.bitwiseOR(day_bit(F.datediff(F.lit(end_date), day), width)),
    )
    bits = F.col("datelist_int")

    def active(days: int):
        return F.bit_count(bits.bitwiseAND(F.lit(last_days_mask(days, width)))) > 0

    return df.select(*keys, mask.alias("datelist_int")).select(
        *keys,
        bits,
        bit_text(bits, width).alias("datelist_bits"),
        F.bit_count(bits).alias("days_active"),
        active(7).alias("active_7d"),
        active(28).alias("active_28d"),
    )
