"""Date arithmetic with the rules of the source data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.44  # fixed value: length of a month when durations are measured


def parse_yyyymmdd(value: Column) -> Column:
    """Integer ``yyyymmdd`` to a date; NULL when it is no calendar date."""
    return F.try_to_timestamp(value.cast("string"), F.lit("yyyyMMdd")).cast("date")


def add_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days if isinstance(days, int) else days.cast("int"))


def subtract_years(day: Column, years: int) -> Column:
    """Same day ``years`` earlier; the 29th of February becomes the 28th."""
    return F.add_months(day, -12 * years)


def months_between_trunc(end: Column, start: Column, days_per_month: float = DAYS_PER_MONTH) -> Column:
    """Whole months from ``start`` to ``end``, cut towards zero."""
    return (F.datediff(end, start) / F.lit(days_per_month)).cast("int")


def add_months_overflow(day: Column, months: int) -> Column:
    """Month shift in which a day past the month's end runs on into the next month."""
    first = F.add_months(F.trunc(day, "month"), months)
    return F.date_add(first, F.dayofmonth(day) - 1)
