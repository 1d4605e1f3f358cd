"""Relational building blocks shared by the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is only hinted for broadcast if the plan bounds its size by so many bytes.
BROADCAST_BYTES = 64 << 20


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """One whole row per key: the first (or last) by ``order_cols``, then by all other columns.

    NULLs come first, NULL keys form a group.  Spark keeps only the best row of each key in every
    map task (window group limit), so the copies of a hot key never meet in one task.
    """
    columns = [*order_cols, *[c for c in df.columns if c not in keys and c not in order_cols]]
    if not columns:
        return df.distinct()
    first = keep == "first"
    by = [F.col(c).asc_nulls_first() if first else F.col(c).desc_nulls_last() for c in columns]
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def top_with_ties(df: DataFrame, measure: str, keys: Sequence[str] = ()) -> DataFrame:
    """All rows that reach the highest ``measure``, overall or per key; NULL never wins.

    Overall, the maximum is a scalar subquery that shares the aggregate's shuffle, and the rows
    stay where they are.  Per key, rank()=1 lets Spark drop losers before the shuffle.
    """
    if not keys:
        best = df.select(F.max(measure)).scalar()
        return df.filter(F.col(measure) == best)
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc_nulls_last())
    return (
        df.filter(F.col(measure).isNotNull())
        .withColumn("_rank", F.rank().over(w))
        .filter("_rank = 1")
        .drop("_rank")
    )


def ordered_desc(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    """Report order: highest measure first, NULLs last, ties by the named columns."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break])


def preview(df: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """Top-n report."""
    ties = [c for c in df.columns if c != measure]
    return ordered_desc(df, measure, *ties).limit(n)


def with_exists_flag(
    df: DataFrame, other: DataFrame, keys: Sequence[str], flag: str
) -> DataFrame:
    """Add whether a row of ``other`` has the same keys (EXISTS used as a value)."""
    seen = other.select(*keys).distinct().withColumn(flag, F.lit(True))
    return df.join(seen, list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all present, rejected rows)."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.filter(present), df.filter(~present)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def assert_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise if ``keys`` hold a NULL or are not unique in ``df``, else return ``df``."""
    _, nulls = split_null_keys(df, keys)
    bad = duplicate_keys(df, keys).drop("rows").unionByName(nulls.select(*keys)).limit(3)
    rows = bad.collect()
    if rows:
        raise ValueError(f"key {tuple(keys)} violated, for example by {rows}")
    return df


def outside_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows whose value is neither NULL nor a member of an enumerated domain."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*domain))


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the optimizer's size of ``df`` is at most ``max_bytes``.

    The size comes from the plan (file sizes, row widths), so no job runs.  A larger side keeps its
    plan, and Spark decides by its own byte threshold, with adaptive skew handling.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def rows_of(*pairs: tuple[Column, Sequence[Column]], names: Sequence[str]) -> Column:
    """array<struct>: one struct per (condition, values) pair whose condition holds."""
    structs = [
        F.when(
            condition,
            F.struct(*[v.alias(n) for v, n in zip(values, names, strict=True)]),
        )
        for condition, values in pairs
    ]
    return F.filter(F.array(*structs), lambda s: s.isNotNull())
