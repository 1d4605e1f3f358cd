"""Period, upsert, bucketed and layout writers on parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_period(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Write the next period(s): only partitions present in ``df`` are replaced.

    Running a period again replaces that period and nothing else.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing rows of the same key, new ones added.

    NULL never equals NULL here, so that a row with a NULL key is always added, unless ``null_safe`` says that
    it is a key like any other.
    """
    if not null_safe:
        return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)
    named = updates.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_u_{key}"))
    return target.join(named, same, "left_anti").unionByName(updates)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    touched: Sequence[Mapping] | None = None,
) -> None:
    """Upsert into a partitioned parquet table, rewriting only partitions that get updates.

    ``partition_cols`` are part of the key, so an update never moves a row between partitions.  A NULL in
    the key equals a NULL, so running an update again changes nothing.  The stored rows of the partitions in ``updates`` are kept by a null-safe semi-join, whatever their
    number.  ``touched`` names the partitions with updates, e.g. ``[{"month": date(2024, 1, 1)}]``, so
    that the stored table is pruned to them; updates outside of them are refused.  Old files are
    replaced when the job commits.
    """
    missing = [c for c in partition_cols if c not in keys]
    if missing:
        raise ValueError(f"partition columns {missing} are not part of the key")
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        write_period(updates, path, partition_cols)  # the first load
        return
    if touched is not None:
        named = F.lit(False)
        for values in touched:
            one = F.lit(True)
            for column in partition_cols:
                one = one & F.col(column).eqNullSafe(F.lit(values[column]))
            named = named | one
        if not updates.filter(~named).isEmpty():
            raise ValueError("updates hold rows outside the partitions named in touched")
        stored = stored.filter(named)
    wanted = updates.select(*[F.col(c).alias(f"_w_{c}") for c in partition_cols]).distinct()
    same = F.lit(True)
    for column in partition_cols:
        same = same & F.col(column).eqNullSafe(F.col(f"_w_{column}"))
    target = stored.join(wanted, same, "left_semi")
    write_period(upsert(target.select(*updates.columns), updates, keys, null_safe=True), path, partition_cols)


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    key: str | Sequence[str],
    path: str | None = None,
    sort: bool = False,
    files_per_bucket: int = 1,
) -> DataFrame:
    """Save ``df`` as a table bucketed on ``key`` (a column or several) and return the stored table.

    Rows are placed by the bucket key first, so each bucket is one file and not one per task.  With
    more ``files_per_bucket`` the rows of a key are also spread by their content, so that the rows
    of a hot key are written by several tasks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if files_per_bucket == 1:
        placed = df.repartition(buckets, *keys)
    else:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
        placed = df.repartition(buckets * files_per_bucket, *keys, spread)
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_layout(
    df: DataFrame, path: str, partition_cols: Sequence[str], sort_cols: Sequence[str] = ()
) -> None:
    """Write ``df`` partitioned by ``partition_cols`` with files sorted by ``sort_cols``.

    The rebalance hint brings equal partition values together but lets Spark split a value that
    holds much of the data over several files.
    """
    ordered = list(dict.fromkeys([*partition_cols, *sort_cols]))
    (
        df.hint("rebalance", *[F.col(c) for c in partition_cols])
        .sortWithinPartitions(*ordered)
        .write.mode("overwrite")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def layout_sizes(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Files and bytes below ``path``; only file metadata is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .agg(
            F.lit(name).alias("layout"),
            F.count("*").alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        )
    )


def compare_layouts(
    df: DataFrame,
    layouts: Mapping[str, tuple[Sequence[str], Sequence[str]]],
    out_dir: str,
) -> DataFrame:
    """Write ``df`` once per layout (name -> partition columns, sort columns) and compare sizes."""
    sizes = None
    for name, (partition_cols, sort_cols) in layouts.items():
        path = f"{out_dir}/{name}"
        write_layout(df, path, partition_cols, sort_cols)
        size = layout_sizes(df.sparkSession, path, name)
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes
