"""Activity bitmasks kept in a BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A BIGINT holds this many day bits without touching the sign bit.
WORD_DAYS = 63


def day_bit(age: Column, width: int = 32) -> Column:
    """Bit of a day ``age`` days back: age 0 is the top bit, ages outside 0..width-1 give 0."""
    inside = (age >= 0) & (age < width)
    shift = F.when(inside, F.lit(width - 1) - age).otherwise(F.lit(0))
    return F.when(inside, F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)).otherwise(
        F.lit(0).cast("bigint")
    )


def bit_text(mask: Column, width: int = 32) -> Column:
    return F.lpad(F.bin(mask), width, "0")


def last_days_mask(days: int, width: int = 32) -> int:
    """Constant mask that selects the most recent ``days`` of a ``width``-day list."""
    return ((1 << days) - 1) << (width - days)


def days_in_words(words: Column, start: Column, n_days: int) -> Column:
    """array<date> of the set bits: bit i of word w stands for ``start`` + w * 63 + i days."""

    def is_set(day: Column) -> Column:
        word = F.get(words, (day / WORD_DAYS).cast("int"))
        return F.call_function("shiftright", word, day % WORD_DAYS).bitwiseAND(F.lit(1)) == 1

    days = F.filter(F.sequence(F.lit(0), F.lit(n_days - 1)), is_set)
    return F.transform(days, lambda day: F.date_add(start, day))
