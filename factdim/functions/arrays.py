"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_array(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")


def zeros(n: Column | int) -> Column:
    """``n`` zeros as array<bigint>; ``n`` may be 0."""
    return F.array_repeat(F.lit(0).cast("bigint"), F.lit(n) if isinstance(n, int) else n)


def fit_to(array: Column, n: Column | int) -> Column:
    """Cut or zero-pad a bigint array to exactly ``n`` slots; NULL counts as empty."""
    size = F.lit(n) if isinstance(n, int) else n
    known = F.coalesce(array, empty_array("bigint"))
    return F.slice(F.concat(known, zeros(size)), F.lit(1), size)


def flat_text(array: Column) -> Column:
    """A one-line text form of an array of scalars (for reports)."""
    return F.array_join(array.cast("array<string>"), ",")
