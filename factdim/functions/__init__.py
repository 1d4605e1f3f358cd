"""Column functions: every one returns a built-in Catalyst expression."""

from .arrays import empty_array, fit_to, flat_text, zeros
from .bits import bit_text, day_bit, days_in_words, last_days_mask
from .scalars import (
    bucket_of,
    from_epoch_ms,
    is_distinct,
    month_start,
    on_day,
    quality_class,
    session_id,
    to_epoch_ms,
    whole_number,
)

__all__ = [
    "bit_text",
    "bucket_of",
    "day_bit",
    "days_in_words",
    "empty_array",
    "fit_to",
    "flat_text",
    "from_epoch_ms",
    "is_distinct",
    "last_days_mask",
    "month_start",
    "on_day",
    "quality_class",
    "session_id",
    "to_epoch_ms",
    "whole_number",
    "zeros",
]
