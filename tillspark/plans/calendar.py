"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.functions.dates import date_key
from tillspark.schemas import DIM_DATE


def calendar(bounds: DataFrame, first: Column, last: Column, is_holiday: Column | None = None) -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row frame ``bounds``.

    Weeks are ISO weeks, days count from 1 = Sunday, the fiscal year is the
    calendar year.  ``is_holiday`` may refer to ``FullDate``.
    """
    day = F.col("FullDate")
    weekday = F.dayofweek(day)
    columns = {
        "DateKey": date_key(day),
        "FullDate": day,
        "DayOfWeek": weekday,
        "DayName": F.date_format(day, "EEEE"),
        "WeekOfYear": F.weekofyear(day),
        "MonthNumber": F.month(day),
        "MonthName": F.date_format(day, "MMMM"),
        "Quarter": F.quarter(day),
        "Year": F.year(day),
        "IsWeekend": weekday.isin(1, 7),
        "IsHoliday": F.lit(False) if is_holiday is None else is_holiday,
        "FiscalYear": F.year(day),
        "FiscalQuarter": F.quarter(day),
    }
    days = bounds.select(F.explode(F.sequence(first, last)).alias("FullDate"))
    return days.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in DIM_DATE])


def calendar_between(spark: SparkSession, first: str, last: str, is_holiday: Column | None = None) -> DataFrame:
    """Calendar between two dates given as ``YYYY-MM-DD``."""
    return calendar(spark.range(0, 1, 1, 1), F.to_date(F.lit(first)), F.to_date(F.lit(last)), is_holiday)
