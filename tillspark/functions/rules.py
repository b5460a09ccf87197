"""Business rules as column expressions, shared by batch, streaming and reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillspark import fixed_values as V


# --- sales load -------------------------------------------------------------
def is_rejected() -> Column:
    """Sale that goes to the reject log."""
    return F.col("OrderID").isNull() | (F.col("Quantity") <= 0) | (F.col("UnitPrice") < 0)


def is_loadable() -> Column:
    """Sale that may be loaded.

    Not the complement of :func:`is_rejected`: a NULL quantity or price makes
    both conditions unknown, and such a row goes nowhere.
    """
    return F.col("OrderID").isNotNull() & (F.col("Quantity") > 0) & (F.col("UnitPrice") >= 0)


# --- churn ------------------------------------------------------------------
def churn_category(score: Column) -> Column:
    return (
        F.when(score >= F.lit(V.HIGH_RISK_FROM), "High")
        .when(score >= F.lit(V.MEDIUM_RISK_FROM), "Medium")
        .otherwise("Low")
    )


def _labelled(value: Column, labels: dict[str, object], default: object = None) -> Column:
    chain = F
    for key, label in labels.items():
        chain = chain.when(value == key, F.lit(label))
    return chain.otherwise(F.lit(default)) if default is not None else chain


def recommended_action(category: Column) -> Column:
    return _labelled(category, V.RECOMMENDED_ACTIONS)


def segment_score(segment: Column) -> Column:
    return _labelled(segment, V.SEGMENT_SCORES, V.OTHER_SEGMENT_SCORE)


def annual_value(avg_order_value: Column) -> Column:
    return avg_order_value * F.lit(V.MONTHS_PER_YEAR)


def revenue_at_risk(category: Column, avg_order_value: Column) -> Column:
    yearly = annual_value(avg_order_value)
    return (
        F.when(category == "High", yearly * F.lit(V.HIGH_RISK_SHARE))
        .when(category == "Medium", yearly * F.lit(V.MEDIUM_RISK_SHARE))
        .otherwise(F.lit(Decimal("0")))
    )


# --- inventory --------------------------------------------------------------
def days_of_supply(on_hand: Column, avg_daily_sales: Column) -> Column:
    """Whole days the stock lasts; the no-sales mark where nothing was sold."""
    sold = F.coalesce(avg_daily_sales, F.lit(0.0))
    days = (on_hand / F.nullif(sold, F.lit(0.0))).cast("int")
    return F.when(sold == 0, F.lit(V.NO_SALES_DAYS_OF_SUPPLY)).otherwise(days)


def stock_out_risk(on_hand: Column, reorder_point: Column) -> Column:
    return F.when(on_hand == 0, "High").when(on_hand <= reorder_point, "Medium").otherwise("Low")


def is_overstocked(on_hand: Column, reorder_point: Column) -> Column:
    return F.coalesce(on_hand > reorder_point * V.OVERSTOCK_FLAG_FACTOR, F.lit(False))


def overstock_cost(flag: Column, unit_cost: Column, on_hand: Column, reorder_point: Column) -> Column:
    excess = on_hand - reorder_point * V.OVERSTOCK_COST_FACTOR
    return F.when(flag, unit_cost * excess).otherwise(F.lit(Decimal("0")))
