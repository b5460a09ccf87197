"""Date keys and calendar arithmetic.  Nothing here reads a clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Date as an int ``YYYYMMDD``, by arithmetic so that no string is built."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def month_of_key(key: Column) -> Column:
    """``YYYYMM`` of a date key: the partition column of the sales fact."""
    return F.floor(key / 100).cast("int")


def key_date(key: Column) -> Column:
    """Date of a ``YYYYMMDD`` key."""
    month = month_of_key(key)
    return F.make_date(F.floor(month / 100).cast("int"), month % 100, key % 100)


def month_bounds(as_of: dt.date) -> tuple[int, int]:
    """First and last possible date key of the month of ``as_of``."""
    base = as_of.year * 10000 + as_of.month * 100
    return base + 1, base + 31


def months_crossed(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates (2025-12-31 to 2026-03-01 is 3)."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def months_before(as_of: dt.date, months: int) -> Column:
    """``as_of`` moved back by whole months, clamped to the month end."""
    return F.add_months(F.lit(as_of), -months)


def long_date(day: Column) -> Column:
    return F.date_format(day, "MMMM dd, yyyy")


def short_date(day: Column) -> Column:
    return F.date_format(day, "MMM dd, yyyy")
