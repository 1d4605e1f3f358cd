"""State changes over periods: player states, growth accounting, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import rows_of

# The state names.
NEW = "New"
CONTINUED = "Continued Playing"
RETIRED = "Retired"
RETURNED = "Returned from Retirement"
STAYED_RETIRED = "Stayed Retired"


def player_state(
    activity: DataFrame,
    key: str = "player_name",
    period: str = "season",
    entities: DataFrame | None = None,
    name: str = "player_state",
) -> DataFrame:
    """State of every key in every period from its debut on.

    The periods are the distinct values of ``period`` in ``activity``; they enter as one array (a
    scalar subquery over the few periods), and a period's place in it tells the period before.
    Inactive periods are generated from the gap to the next active one: keys are never crossed
    with periods.  ``entities`` restricts the keys.
    """
    present = activity.select(key, period).dropna().distinct()
    axis = activity.select(F.array_sort(F.collect_set(period))).scalar()
    if entities is not None:
        present = present.join(entities.select(key), key, "left_semi")
    placed = present.select(key, F.array_position(axis, F.col(period)).cast("int").alias("_at"))
    w = Window.partitionBy(key).orderBy("_at")
    before, after = F.lag("_at").over(w), F.lead("_at").over(w)
    active_state = (
        F.when(before.isNull(), NEW).when(before == F.col("_at") - 1, CONTINUED).otherwise(RETURNED)
    )
    spans = placed.select(
        key,
        "_at",
        active_state.alias("_state"),
        (F.coalesce(after, F.size(axis) + 1) - 1).alias("_until"),
    )
    at = F.explode(F.sequence("_at", "_until")).alias("_period_at")
    state = (
        F.when(F.col("_period_at") == F.col("_at"), F.col("_state"))
        .when(F.col("_period_at") == F.col("_at") + 1, RETIRED)
        .otherwise(STAYED_RETIRED)
    )
    return spans.select("*", at).select(
        key, F.element_at(axis, F.col("_period_at")).alias(period), state.alias(name)
    )


# 1970-01-01 was a Thursday: three days after a Monday.
_WEEK_SHIFT = 3


def _period_number(ts: Column, grain: str) -> Column:
    days = F.unix_date(F.to_date(ts))
    if grain == "day":
        return days
    if grain == "week":
        return F.floor((days + _WEEK_SHIFT) / 7).cast("int")
    raise ValueError("grain must be day or week")


def _period_date(number: Column, grain: str) -> Column:
    return F.date_from_unix_date(number if grain == "day" else number * 7 - _WEEK_SHIFT)


def _on_spine(deltas: DataFrame, lo: Column, hi: Column, columns: Sequence[str]) -> DataFrame:
    """Sums of ``deltas`` per ``_p``, with a zero row for every period of the calendar."""
    spine = deltas.sparkSession.range(1).select(
        F.explode(F.sequence(lo, hi)).alias("_p"), *[F.lit(0).cast("bigint").alias(c) for c in columns]
    )
    return (
        deltas.unionByName(spine)
        .groupBy("_p")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .filter(F.col("_p") <= hi)
    )


def growth_accounting(
    activity: DataFrame, key: str = "user_id", ts_col: str = "event_time", grain: str = "day"
) -> DataFrame:
    """Per period: new, retained, resurrected, churned and stale keys, actives and net change.

    churned = active in the period before but not now; stale = inactive for longer.  Each active
    (key, period) contributes +1/-1 changes at the few periods where a count starts or stops, so
    the work grows with activity and not with keys x periods; only the per-period sums, one row
    per day or week of the calendar, pass through the final running sum.
    """
    present = (
        activity.select(key, _period_number(F.col(ts_col), grain).alias("_p")).dropna().distinct()
    )
    lo, hi = present.select(F.min("_p")).scalar(), present.select(F.max("_p")).scalar()
    w = Window.partitionBy(key).orderBy("_p")
    seen = present.withColumn("_prev", F.lag("_p").over(w)).withColumn("_next", F.lead("_p").over(w))
    columns = ["new", "retained", "resurrected", "churned", "_stale"]

    def change(**values) -> list[Column]:
        return [F.lit(values.get(c, 0)).cast("bigint") for c in columns]

    p, prev, nxt = F.col("_p"), F.col("_prev"), F.col("_next")
    leaves = nxt.isNull() | (nxt > p + 1)
    names = ["_p", *columns]
    rows = rows_of(
        (prev.isNull(), [p, *change(new=1)]),
        (prev == p - 1, [p, *change(retained=1)]),
        (prev < p - 1, [p, *change(resurrected=1)]),
        (leaves, [p + 1, *change(churned=1)]),
        (leaves, [p + 2, *change(_stale=1)]),
        (leaves & nxt.isNotNull(), [nxt, *change(_stale=-1)]),
        names=names,
    )
    deltas = seen.select(F.explode(rows).alias("_row")).select("_row.*")
    per_period = _on_spine(deltas, lo, hi, columns)
    calendar = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    return per_period.select(
        _period_date(F.col("_p"), grain).alias("period"),
        "new",
        "retained",
        "resurrected",
        "churned",
        F.sum("_stale").over(calendar).alias("stale"),
        (F.col("new") + F.col("retained") + F.col("resurrected")).alias("active"),
        (F.col("new") + F.col("resurrected") - F.col("churned")).alias("net_change"),
    )


def daily_growth(activity: DataFrame, key: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """Active keys per day and their growth over the day before (NULL where there is none)."""
    daily = growth_accounting(activity, key, ts_col, "day")
    before = F.lag("active").over(Window.orderBy("period"))
    return daily.select(
        "period",
        "active",
        "net_change",
        F.when(before > 0, (F.col("active") - before) / before).alias("growth_rate"),
    )


def retention(
    activity: DataFrame,
    key: str = "user_id",
    ts_col: str = "event_time",
    days: Sequence[int] = (7,),
    weeks: Sequence[int] = (1, 4),
) -> DataFrame:
    """Share of each first-day cohort active on day n and in week n (days 7n-6 .. 7n).

    NULL where day n, or the end of week n, lies after the last day of the table: it has not happened.
    """
    present = activity.select(key, F.to_date(ts_col).alias("_date")).dropna().distinct()
    first = F.min("_date").over(Window.partitionBy(key))
    aged = present.select(key, first.alias("cohort"), F.datediff("_date", first).alias("_age"))
    age = F.col("_age")
    marks = {f"day_{d}": age == d for d in days}
    marks |= {f"week_{n}": age.between(7 * n - 6, 7 * n) for n in weeks}
    per_key = aged.groupBy(key, "cohort").agg(
        *[F.max(F.when(m, 1).otherwise(0)).alias(n) for n, m in marks.items()]
    )
    last = present.select(F.max("_date")).scalar()
    needed = {f"day_{d}": d for d in days} | {f"week_{n}": 7 * n for n in weeks}
    shares = per_key.groupBy("cohort").agg(
        F.count("*").alias("users"), *[(F.sum(n) / F.count("*")).alias(f"{n}_share") for n in marks]
    )
    observed = {n: F.date_add("cohort", d) <= last for n, d in needed.items()}
    return shares.select(
        "cohort", "users", *[F.when(observed[n], F.col(f"{n}_share")).alias(f"{n}_share") for n in marks]
    )
