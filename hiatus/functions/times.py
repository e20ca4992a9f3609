"""Time column expressions used by the session and series operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SESSION_NUMBER_DIGITS = 8


def gap_to_micros(gap_minutes: float) -> int:
    if gap_minutes < 0:
        raise ValueError(f"gap_minutes must not be negative: {gap_minutes}")
    return round(gap_minutes * 60_000_000)


def slice_start(moment: Column, width_micros: int) -> Column:
    """Start, in epoch microseconds, of the fixed-width time slice holding ``moment``.

    Integer arithmetic with a non-negative remainder, so slices have the same
    width on both sides of 1970.
    """
    micros = F.unix_micros(moment)
    return micros - F.pmod(micros, F.lit(width_micros).cast("long"))


def whole_seconds(moment: Column) -> Column:
    return moment.cast("long")


def session_id(user: Column, number: Column) -> Column:
    """``<user>-<number padded to 8 digits>``; longer numbers are not cut."""
    digits = number.cast("string")
    width = F.greatest(F.lit(SESSION_NUMBER_DIGITS), F.length(digits))
    return F.concat_ws("-", user.cast("string"), F.lpad(digits, width, F.lit("0")))


def duration_columns(start: Column, end: Column) -> list[Column]:
    """Session length in whole seconds (never negative) and in minutes."""
    seconds = F.greatest(F.lit(0).cast("long"), whole_seconds(end) - whole_seconds(start))
    return [
        seconds.alias("session_duration_seconds"),
        (seconds / F.lit(60.0)).alias("session_duration_minutes"),
    ]


def next_month(month: Column, steps=1) -> Column:
    return F.add_months(month, steps)


def utc_instant(clock: Column) -> Column:
    """The instant of a zone-less UTC time, whatever the session's zone is.

    Days and the time of day are counted on the zone-less calendar, so hours that a
    local clock repeats or leaves out make no difference.
    """
    clock = clock.cast("timestamp_ntz")
    day = F.unix_date(clock.cast("date")).cast("long")
    minutes = (day * 24 + F.hour(clock)) * 60 + F.minute(clock)
    micros = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("long")
    return F.timestamp_micros(minutes * 60_000_000 + micros)


def utc_clock(moment: Column) -> Column:
    """The zone-less UTC time of an instant, whatever the session's zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), _epoch())


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")
