"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SQL interval of one period, and the truncation unit of its first day.
_PERIODS = {"month": ("INTERVAL 1 MONTH", "MM"), "week": ("INTERVAL 7 DAY", "WEEK"), "day": ("INTERVAL 1 DAY", None)}


def parsed_time(col: Column, strict: bool = True, fmt: str | None = None) -> Column:
    """Text to timestamp: ``strict`` raises on bad input, otherwise it becomes null."""
    args = (col,) if fmt is None else (col, F.lit(fmt))
    return F.to_timestamp(*([col] if fmt is None else [col, fmt])) if strict else F.try_to_timestamp(*args)


def period_start(ts: Column, period: str = "month") -> Column:
    """First day of the month, week or day holding ``ts``, as a date in the value's own zone."""
    day = ts.cast("date")
    unit = _PERIODS[period][1]
    return F.trunc(day, unit) if unit else day


def step_interval(period: str) -> Column:
    return F.expr(_PERIODS[period][0])


def next_period(ds: Column, period: str = "month", n: Column | int = 1) -> Column:
    if period == "month":
        return F.add_months(ds, n)
    days = 7 if period == "week" else 1
    return F.date_add(ds, (n if isinstance(n, Column) else F.lit(n)) * days)


def month_of_year(ds: Column) -> Column:
    return F.month(ds)


def month_index(ds: Column) -> Column:
    """Months since year 0, a whole number that is linear in calendar months."""
    return F.year(ds) * 12 + F.month(ds)


def period_index(ds: Column, period: str = "month") -> Column:
    """A whole number that grows by one from each month, week or day to the next."""
    if period == "month":
        return month_index(ds)
    days = F.datediff(ds, F.lit("1970-01-05").cast("date"))  # a Monday
    return F.floor(days / 7).cast("int") if period == "week" else days


def day_text(ds: Column) -> Column:
    return F.date_format(ds, "yyyy-MM-dd")
