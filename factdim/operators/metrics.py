"""Business metrics: profit and engagement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .growth import _on_spine
from .relational import rows_of


def profit_cents(price: Column, discount: Column) -> Column:
    """Revenue less discount as whole cents, so that sums do not depend on their order."""
    return F.round(price * (F.lit(1) - discount) * 100).cast("bigint")


def unit_profit(
    lines: DataFrame,
    keys: tuple[str, ...] = ("l_orderkey", "l_linenumber"),
    price: str = "l_extendedprice",
    discount: str = "l_discount",
) -> DataFrame:
    """Profit of every order line, in cents."""
    return lines.select(*keys, profit_cents(F.col(price), F.col(discount)).alias("profit_cents"))


def aggregate_profit(
    lines: DataFrame,
    ts_col: str = "l_shipdate",
    price: str = "l_extendedprice",
    discount: str = "l_discount",
) -> DataFrame:
    """Lines and profit per day."""
    return lines.groupBy(F.to_date(ts_col).alias("date")).agg(
        F.count("*").alias("lines"),
        F.sum(profit_cents(F.col(price), F.col(discount))).alias("profit_cents"),
    )


def engagement(
    events: DataFrame, key: str = "user_id", ts_col: str = "event_time", window: int = 28
) -> DataFrame:
    """Per day: DAU, MAU over the trailing ``window`` days, DAU/MAU and events per active user.

    A user counts towards MAU from an active day until ``window`` days later or the next active
    day, whichever is first: one +1 and one -1 per active day instead of a row for each of the
    following days.
    """
    daily = (
        events.dropna(subset=[key, ts_col])
        .groupBy(key, F.unix_date(F.to_date(ts_col)).alias("_p"))
        .agg(F.count("*").alias("_events"))
    )
    lo, hi = daily.select(F.min("_p")).scalar(), daily.select(F.max("_p")).scalar()
    after = F.lead("_p").over(Window.partitionBy(key).orderBy("_p"))
    daily = daily.withColumn("_until", F.least(after, F.col("_p") + window))
    p, until = F.col("_p"), F.col("_until")
    columns = ["dau", "_events", "_change"]

    def values(dau, events_, change) -> list[Column]:
        return [F.lit(dau).cast("bigint"), events_, F.lit(change).cast("bigint")]

    rows = rows_of(
        (F.lit(True), [p, *values(1, F.col("_events"), 1)]),
        (F.lit(True), [until, *values(0, F.lit(0).cast("bigint"), -1)]),
        names=["_p", *columns],
    )
    deltas = daily.select(F.explode(rows).alias("_row")).select("_row.*")
    calendar = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _on_spine(deltas, lo, hi, columns)
        .withColumn("mau", F.sum("_change").over(calendar))
        .select(
            F.date_from_unix_date("_p").alias("date"),
            "dau",
            "mau",
            (F.col("dau") / F.col("mau")).alias("dau_mau"),
            F.when(F.col("dau") > 0, F.col("_events") / F.col("dau")).alias("events_per_user"),
        )
        .filter(F.col("mau") > 0)
    )
