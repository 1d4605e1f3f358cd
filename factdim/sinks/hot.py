"""Bucketed tables in which a key may hold much of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import write_bucketed

#: A key with this share of the rows is kept out of the buckets.
HOT_SHARE = 0.01


def heavy_hitters(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` with about ``share`` of the rows or more: 1 / share values at most.

    Each task keeps a sketch of its frequent values, the sketches are merged, and only the merged one is read by the
    driver; no value is shuffled.  Counts are estimates within a tenth of ``share``, so use the answer to place
    rows, not to choose them.  NULL is no value.
    """
    if not 1e-5 <= share <= 1:
        raise ValueError("share must lie between 0.00001 and 1")
    most = math.ceil(1 / share)
    tracked = max(1024, 40 * most) if share > 4e-5 else 1_000_000
    top = F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")
    found = df.where(F.col(key).isNotNull()).agg(top, F.count("*").alias("rows")).first()
    return sorted(r["item"] for r in found.top or [] if r["count"] >= share * found.rows)


def write_bucketed_hot(
    df: DataFrame, table: str, buckets: int, key: str, hot: Sequence, spread: Sequence[str], path: str
) -> tuple[DataFrame, DataFrame]:
    """Save ``df`` as two tables, (cold, hot): rows of the ``hot`` values of ``key`` and all others.

    The cold table is bucketed on ``key``.  The hot one is bucketed on ``key`` and ``spread``, which deals the rows of
    one value over all buckets; two hot tables with the same ``spread`` still join bucket by bucket.  Rows without
    key lie in the hot table, as there may be many.
    """
    apart = F.col(key).isNull() | F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    cold = write_bucketed(df.where(~apart), f"{table}_cold", buckets, key, f"{path}/cold")
    return cold, write_bucketed(df.where(apart), f"{table}_hot", buckets, [key, *spread], f"{path}/hot")
