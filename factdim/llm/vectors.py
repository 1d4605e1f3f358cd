"""What the two vector searches share: rows that take part, slabs of rows, chunks of queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """vec_id and embedding (double) of the vectors that take part in a search.

    Left out: null ids, null or empty vectors, null or non-finite components and, unless ``zero``, vectors
    of zeros.  Rows that share a vec_id
    are one vector, the smallest of them.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    found = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")).where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite
    )
    if not zero:
        found = found.where(F.exists("embedding", lambda x: x != 0))
    return found.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))


def parts(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def dealt(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def search_slabs(
    slabs: DataFrame,
    queries: DataFrame,
    n_slabs: int,
    n_chunks: int,
    find: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    k: int,
    descending: bool,
    score_type: str,
) -> DataFrame:
    """Meet every chunk of the stated queries with every slab of rows, then keep the best ``k`` of a query.

    ``slabs`` has dim and slab, ``queries`` has dim and vec_id.  Only vectors of one length meet.
    A task holds one slab and one chunk; it returns at most ``k`` rows a query.
    """
    left = slabs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = queries.withColumn("chunk", dealt("vec_id", n_chunks)).withColumn(
        "slab", F.explode(F.sequence(F.lit(0), F.lit(n_slabs - 1)))
    )
    keys = ("dim", "slab", "chunk")

    def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if len(rows) and len(asked):
            return find(rows, asked)
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        meet, f"query_id long, vec_id long, score {score_type}"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if descending else F.asc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])
