"""Type-2 history of slowly changing attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_distinct

ACTOR_ATTRS = ("quality_class", "is_active")


def _any(conditions: Sequence[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def scd2_backfill(
    snapshots: DataFrame,
    key: str = "actorid",
    attrs: Sequence[str] = ACTOR_ATTRS,
    period: str = "current_year",
    label: str | None = "actor",
    start: str = "start_year",
    end: str = "end_year",
    break_on_gap: bool = True,
    as_of: int | None = None,
) -> DataFrame:
    """Runs of unchanged ``attrs`` per key over all snapshots up to ``as_of`` (default: the last).

    ``snapshots`` hold one row per key and period.  ``label`` is a descriptive column that does
    not open a run; its latest value in the run is kept.  With ``break_on_gap`` a missing period
    ends a run, as it does when the history is built period by period.
    """
    if as_of is not None:
        snapshots = snapshots.filter(F.col(period) <= as_of)
        stamp = F.lit(as_of)
    else:
        stamp = snapshots.select(F.max(period)).scalar()
    w = Window.partitionBy(key).orderBy(period)
    changes = [is_distinct(F.col(a), F.lag(a).over(w)) for a in attrs]
    if break_on_gap:
        changes.append(is_distinct(F.lag(period).over(w), F.col(period) - 1))
    names = [label] if label else []
    flagged = snapshots.select(
        key, *names, *attrs, period, F.when(_any(changes), 1).otherwise(0).alias("_change")
    )
    runs = flagged.withColumn(
        "_run", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        runs.groupBy(key, "_run", *attrs)
        .agg(
            *[F.max_by(n, period).alias(n) for n in names],
            F.min(period).alias(start),
            F.max(period).alias(end),
        )
        .select(key, *names, *attrs, start, end, stamp.alias(period))
    )


def scd2_increment(
    history: DataFrame,
    snapshot: DataFrame,
    year: int,
    key: str = "actorid",
    attrs: Sequence[str] = ACTOR_ATTRS,
    period: str = "current_year",
    label: str | None = "actor",
    start: str = "start_year",
    end: str = "end_year",
    last_period: int | None = None,
) -> DataFrame:
    """History as of ``year`` from the history as of ``year`` - 1 and the snapshot of ``year``.

    Only runs that reached ``year`` - 1 take part in the join, one row per key on either side:
    unchanged runs grow by a period, changed ones stay closed beside a new run, new keys open a
    run, keys without a snapshot stay closed.  Running a year again gives the same rows: the step of
    ``year`` is taken back first.  A history that is neither empty nor one (or zero) periods behind is
    refused.  Where the history ends is
    looked up, which is cheap in a table partitioned by ``period``, unless ``last_period`` tells.
    """
    last = last_period or history.select(F.max(period)).first()[0]
    if last is not None and last not in (year - 1, year):
        raise ValueError(f"history ends at {last}, cannot add {year}")
    names = [label] if label else []
    columns = [key, *names, *attrs, start, end]
    if last == year:
        # take the step back: runs opened in ``year`` go, runs that reached it end a period earlier
        stamped = history.filter((F.col(period) == year) & (F.col(start) < year))
        type_of_end = history.schema[end].dataType
        base = stamped.withColumn(end, F.least(F.col(end), F.lit(year - 1)).cast(type_of_end))
    else:
        base = history.filter(F.col(period) == year - 1)
    closed = base.filter(F.col(end) < year - 1).select(*columns)
    o = base.filter(F.col(end) == year - 1).select(*columns).alias("o")
    s = snapshot.filter(F.col(period) == year).select(key, *names, *attrs).alias("s")

    def row(side: str, first: Column, last_period: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in [key, *names, *attrs]]
        return F.struct(*fields, first.alias(start), last_period.alias(end))

    now = F.lit(year).cast(history.schema[end].dataType)
    kept = row("o", F.col(f"o.{start}"), F.col(f"o.{end}"))
    grown = row("s", F.col(f"o.{start}"), now)
    opened = row("s", now, now)
    changed = _any([is_distinct(F.col(f"o.{a}"), F.col(f"s.{a}")) for a in attrs])
    rows = (
        F.when(F.col(f"o.{key}").isNull(), F.array(opened))
        .when(F.col(f"s.{key}").isNull(), F.array(kept))
        .when(changed, F.array(kept, opened))
        .otherwise(F.array(grown))
    )
    current = (
        o.join(s, F.col(f"o.{key}") == F.col(f"s.{key}"), "full")
        .select(F.explode(rows).alias("_row"))
        .select("_row.*")
    )
    return closed.unionByName(current).withColumn(period, F.lit(year))
