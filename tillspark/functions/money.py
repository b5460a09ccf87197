"""Money arithmetic in decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"
HUNDRED = Decimal("100")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient; 0 where the denominator is zero or missing, NULL where only the numerator is."""
    blank = denominator.isNull() | (denominator == 0)
    return F.when(blank, F.lit(0)).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def guarded_ratio(numerator: Column, denominator: Column, scale: Decimal | None = None) -> Column:
    """Quotient, times ``scale``, to two places; NULL where the denominator is zero or missing."""
    ratio = numerator / F.nullif(denominator, F.lit(0))
    return F.round(ratio if scale is None else ratio * F.lit(scale), 2)


def percent_of(part: Column, whole: Column) -> Column:
    return guarded_ratio(part, whole, HUNDRED)


def gross_sales(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast(MONEY)


def net_sales(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Line total after a discount given in percent; six places hold it exactly."""
    return (quantity * unit_price * (F.lit(Decimal("1")) - discount * F.lit(Decimal("0.01")))).cast(MONEY)


def unit_margin_percent(unit_price: Column, unit_cost: Column) -> Column:
    """Margin of one unit in percent of its price; 0 unless the price is positive."""
    margin = F.round((unit_price - unit_cost) / F.nullif(unit_price, F.lit(0)) * F.lit(HUNDRED), 2)
    return F.when(unit_price > 0, margin).otherwise(F.lit(0)).cast("decimal(10,2)")


def number_or_zero(value: Column, kind: str) -> Column:
    """Value as a JSON-friendly number, 0 for NULL."""
    return F.coalesce(value.cast(kind), F.lit(0).cast(kind))
