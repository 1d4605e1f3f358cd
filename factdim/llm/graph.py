"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factdim.llm.common import settle


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the smallest node of its component.

    A step hangs the neighbours of each node below the smallest one; the steps alternate until the
    edges stay the same, which takes about log(longest path) rounds.  Every round is written to the
    shared folder; the driver sees two numbers of it.
    """
    edges = settle(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _fingerprint(edges)
    while before[0]:
        edges = settle(_small_star(_large_star(edges)), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = F.least("u", "m")
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), smallest.alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
