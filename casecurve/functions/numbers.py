"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(col: Column) -> Column:
    """Text or number to double; unreadable text and NaN become null."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def half_even(col: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals."""
    return F.bround(col, digits)


def whole_cases(prediction: Column) -> Column:
    """A predicted count: floored at zero, rounded half to even, as a whole number."""
    return F.rint(F.greatest(prediction, F.lit(0.0))).cast("long")


def per_thousand_to_count(col: Column) -> Column:
    """Laboratory values reported in thousands per microlitre as plain counts."""
    return lenient_double(col) * 1000.0


def positive_flag(col: Column) -> Column:
    """1 where the value is above zero, else 0 (missing counts as 0)."""
    return F.coalesce((col > 0).cast("int"), F.lit(0))


def number_or_zero(col: Column) -> Column:
    return F.coalesce(lenient_double(col), F.lit(0.0))


def half_up(col: Column, digits: int) -> Column:
    """Round half upwards, the rule of browser-side number formatting."""
    scale = float(10**digits)
    return F.floor(col * scale + 0.5) / scale
