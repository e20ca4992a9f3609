from hiatus.functions.numbers import percentage, rounded_half_even
from hiatus.functions.times import (
    duration_columns,
    gap_to_micros,
    next_month,
    session_id,
    slice_start,
    utc_clock,
    utc_instant,
    whole_seconds,
)

__all__ = [
    "duration_columns",
    "gap_to_micros",
    "next_month",
    "percentage",
    "rounded_half_even",
    "session_id",
    "slice_start",
    "utc_clock",
    "utc_instant",
    "whole_seconds",
]
