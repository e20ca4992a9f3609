"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` to 4 decimals; null when ``whole`` is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 4)


def rounded_half_even(value: Column) -> Column:
    """Nearest integer, ties to the even neighbour."""
    return F.bround(value, 0).cast("int")
