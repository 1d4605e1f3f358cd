"""Experiment cells and their metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket_of


def assign_cells(
    users: DataFrame, experiment: str, cells: Mapping[str, int], key: str = "user_id"
) -> DataFrame:
    """Put every distinct user into a cell; ``cells`` maps cell to percent and adds up to 100.

    The bucket is a hash of experiment and user: stable, and independent between experiments.
    """
    if sum(cells.values()) != 100:
        raise ValueError("cell shares must add up to 100")
    bucket = bucket_of(F.lit(experiment), F.col(key))
    upper, cell = 0, None
    for name, share in cells.items():
        upper += share
        cell = (F if cell is None else cell).when(bucket < upper, name)
    return users.select(key).dropna().distinct().select(
        key, F.lit(experiment).alias("experiment"), cell.alias("cell")
    )


def cell_metrics(
    assignment: DataFrame,
    facts: DataFrame,
    metrics: Mapping[str, Column],
    control: str,
    key: str = "user_id",
) -> DataFrame:
    """Per cell and metric: users, mean, variance, lift over control and Welch's z.

    ``metrics`` are aggregates of ``facts`` per user.  Facts are reduced to one row per user before
    the join, users without facts count as 0, and means and variances are merged from partial ones,
    which neither overflow nor cancel.
    """
    per_user = facts.groupBy(key).agg(*[m.alias(f"_m_{n}") for n, m in metrics.items()])
    value = {n: F.coalesce(f"_m_{n}", F.lit(0)).cast("double") for n in metrics}
    wide = (
        assignment.join(per_user, key, "left")
        .groupBy("experiment", "cell")
        .agg(
            F.count("*").alias("users"),
            *[
                F.struct(F.lit(m).alias("metric"), F.avg(v).alias("mean"), F.var_samp(v).alias("variance")).alias(f"_x_{m}")
                for m, v in value.items()
            ],
        )
    )
    # the few rows, one per cell, are turned into one per cell and metric
    stats = wide.select("experiment", "cell", "users", F.inline(F.array(*[f"_x_{m}" for m in metrics]))).select(
        "experiment", "cell", "metric", "users", "mean", "variance"
    )
    n = F.col("users")
    # one row per cell: the control row is read from the few rows of the same metric
    peers = Window.partitionBy("experiment", "metric")

    def of_control(column: str) -> Column:
        return F.max(F.when(F.col("cell") == control, F.col(column))).over(peers)

    compared = stats.select(
        "*",
        of_control("users").alias("_n0"),
        of_control("mean").alias("_mean0"),
        of_control("variance").alias("_var0"),
    )
    spread = F.sqrt(F.col("variance") / n + F.col("_var0") / F.col("_n0"))
    is_test = F.col("cell") != control
    return compared.select(
        "experiment",
        "cell",
        "metric",
        "users",
        "mean",
        "variance",
        F.when(
            is_test & (F.col("_mean0") != 0), (F.col("mean") - F.col("_mean0")) / F.col("_mean0")
        ).alias("lift"),
        F.when(is_test & (spread > 0), (F.col("mean") - F.col("_mean0")) / spread).alias("welch_z"),
    )


def cell_sizes(assignment: DataFrame, by: Sequence[str] = ("experiment", "cell")) -> DataFrame:
    """Users per cell."""
    return assignment.groupBy(*by).agg(F.count("*").alias("users"))
