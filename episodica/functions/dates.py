"""Date expressions in whole days and weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_between(end: Column, start: Column) -> Column:
    """Signed days from ``start`` to ``end`` as int."""
    return F.datediff(end, start)


def whole_weeks(end: Column, start: Column, unit_days: int = 7) -> Column:
    """Signed whole units (weeks) from ``start`` to ``end``, cut towards zero."""
    return F.call_function("div", F.datediff(end, start), F.lit(unit_days)).cast("int")


def as_midnight(day: Column) -> Column:
    """A date as a timestamp without zone."""
    return day.cast("timestamp_ntz")


def lookback(day: Column, as_of: Column, days: int) -> Column:
    """True for the last ``days`` days before ``as_of``, the first of them included."""
    return day >= F.date_sub(as_of, days)


def within(day: Column, start: Column, end: Column) -> Column:
    """Closed interval; NULL bounds give NULL, which no filter takes."""
    return (day >= start) & (day <= end)
