"""Running totals and rolling sums that survive a hot key.

A plain window puts every row of a key into one task.  Here the ordering column is cut into slots of a fixed
width, and sums are made on two levels: inside (key, slot), each by a task of its own, and over the slots of a
key, one row each, whose sums of earlier slots are added afterwards.  The plan is the same for every input:
nothing is counted or brought to the driver while it is built.  The result equals the plain window exactly, whatever
the width; a slot holds as many rows of a key as have order values in its range, so the width bounds a
task where ordering values are unique per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Units of the ordering column in a slot: numbers, days of a date, seconds of a timestamp.
SLOT_WIDTH = 1_000_000
#: Rows of a key that a task of a rolling sum holds, besides those it borrows from the block before.
BLOCK_ROWS = 1_000_000

_UPTO_HERE = (Window.unboundedPreceding, Window.currentRow)


def slot_of(df: DataFrame, order: str, slots: int | Column = SLOT_WIDTH) -> Column:
    """The slot of a row: it never falls along ``order``, and is NULL where ``order`` is.

    ``slots`` is the width of a slot for whole numbers, decimals, dates (days) and timestamps (seconds).  Any
    other ordering column, such as text, needs a column expression that rises with it, for example its
    first letters; without one it is refused.
    """
    if isinstance(slots, Column):
        return slots
    if slots < 1:
        raise ValueError("a slot is at least one unit wide")
    kind, value = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.DateType):
        value = F.datediff(value, F.lit("1970-01-01").cast("date"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_seconds(value.cast("timestamp"))
    elif not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise TypeError(f"{order} is {kind.simpleString()}: name its slots by a column that rises with it")
    return F.floor(value / F.lit(slots)) if isinstance(kind, T.DecimalType) else F.call_function(
        "div", value, F.lit(slots)
    )


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def slot_offsets(slotted: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per key and ``_slot`` the sums of all earlier slots of the key, as ``_before_<name>``; 0 for the first."""
    before = Window.partitionBy(*keys).orderBy(F.col("_slot").asc_nulls_first())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return (
        slotted.groupBy(*keys, "_slot")
        .agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
        .select(
            *[F.col(k).alias(f"_of_{k}") for k in keys],
            F.col("_slot").alias("_of_slot"),
            *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        )
    )


def with_offsets(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (with ``_slot``) and the offsets of their key and slot."""
    same = F.col("_slot").eqNullSafe(F.col("_of_slot"))
    for key in keys:
        same = same & (F.col(key) == F.col(f"_of_{key}"))
    return rows.join(offsets, same).drop("_of_slot", *[f"_of_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Mapping[str, Column],
    slots: int | Column = SLOT_WIDTH,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums per key along (``order``, ``tie_break``), NULLs first.

    Rows with a NULL key are left out; values that are NULL count as nothing.  ``order`` with ``tie_break``
    should be unique per key.  ``slots``: see :func:`slot_of`.
    """
    keys = list(keys)
    slotted = df.dropna(subset=keys).withColumn("_slot", slot_of(df, order, slots))
    inside = Window.partitionBy(*keys, "_slot").orderBy(*_ascending([order, *tie_break])).rowsBetween(*_UPTO_HERE)
    local = slotted.select("*", *[F.sum(c).over(inside).alias(f"_local_{n}") for n, c in totals.items()])
    summed = [(F.coalesce(f"_local_{n}", F.lit(0)) + F.col(f"_before_{n}")).alias(n) for n in totals]
    return with_offsets(local, slot_offsets(slotted, keys, totals), keys).select(*df.columns, *summed)


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    rows: int,
    name: str,
    slots: int | Column = SLOT_WIDTH,
    tie_break: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the current and the ``rows`` - 1 previous rows of the key; NULL if all are NULL.

    Running totals give every row its position in the key.  Positions are cut into blocks, and the last
    ``rows`` - 1 rows of a block are lent to the next one, where they only feed the frames of its first rows.
    """
    block_rows = max(block_rows, rows)
    placed = running_totals(df.withColumn("_value", value), keys, order, {"_pos": F.lit(1)}, slots, tie_break)
    within = F.pmod(F.col("_pos") - 1, F.lit(block_rows))
    home = F.col("_pos") - within
    lends = within >= block_rows - (rows - 1)
    blocks = F.when(lends, F.array(home, home + block_rows)).otherwise(F.array(home))
    frame = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        placed.withColumn("_home", home)
        .withColumn("_block", F.explode(blocks))
        .withColumn(name, F.sum("_value").over(frame))
        .filter(F.col("_block") == F.col("_home"))
        .select(*df.columns, name)
    )
