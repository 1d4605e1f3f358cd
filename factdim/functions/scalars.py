"""Scalar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import QUALITY, QUALITY_FLOORS


def is_distinct(left: Column, right: Column) -> Column:
    """NULL-safe inequality; never NULL itself."""
    return ~left.eqNullSafe(right)


def quality_class(average: Column, strict: bool = False) -> Column:
    """Class of an average rating; ``strict`` asks for more than the floor instead of reaching it."""
    chain = None
    for name in reversed(QUALITY[1:]):
        floor = F.lit(QUALITY_FLOORS[name])
        reached = average > floor if strict else average >= floor
        chain = F.when(reached, name) if chain is None else chain.when(reached, name)
    return F.when(average.isNotNull(), chain.otherwise(QUALITY[0]))


def whole_number(text: Column, kind: str = "int") -> Column:
    """Text as an integer type, NULL where it is none.

    The pattern keeps plainly wrong text away from ``try_cast``, which is slow when it fails.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast(kind))


def on_day(ts: Column, day: dt.date) -> Column:
    """Rows of one calendar day as a range test, which parquet scans can push down."""
    return (ts >= F.lit(day)) & (ts < F.lit(day + dt.timedelta(days=1)))


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def session_id(ip: Column, host: Column, start_ms: Column) -> Column:
    """Deterministic session id; the joined text is a fixed format."""
    return F.md5(F.concat_ws("|", ip, host, start_ms.cast("string")))


def bucket_of(salt: Column, key: Column, buckets: int = 100) -> Column:
    """Deterministic bucket 0..buckets-1 of a key, independent between salts."""
    digest = F.md5(F.concat_ws("|", salt, key.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets)).cast("int")
