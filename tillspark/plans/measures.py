"""Report measures.

Each function aggregates a report frame ``by`` any of its columns; without
``by`` it gives the grand total.  The ``_report`` functions give rows, subtotals
and grand total of a report at once, from one pass over the frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark import fixed_values as V
from tillspark.functions.money import safe_divide


def _evaluate(df: DataFrame, measures: dict[str, Column], by: list[str] | None) -> DataFrame:
    aggregates = [c.alias(name) for name, c in measures.items()]
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def _in_contexts(df: DataFrame, measures: dict[str, Column], contexts: list[list[str]]) -> DataFrame:
    """Measures under several filter contexts: one row per combination of values that a context's columns have.

    ``Context`` tells them apart.  It has a bit per column, the first column's
    being the highest, which is 1 where the row sums over all values of that
    column; so a value that is NULL and a subtotal differ.  The frame is scanned
    once, whatever the number of contexts.  ``contexts`` may contain each other.
    """
    columns = list(dict.fromkeys(c for context in contexts for c in context))
    if not columns:
        return _evaluate(df, measures, None).select(F.lit(0).cast("long").alias("Context"), "*")
    aggregates = [c.alias(name) for name, c in measures.items()]
    rows = df.groupingSets([[F.col(c) for c in context] for context in contexts], *columns)
    return rows.agg(F.grouping_id().alias("Context"), *aggregates)


def levels(by: list[str]) -> list[list[str]]:
    """The contexts of a report with subtotals: all columns, all but the last, and so on to the grand total."""
    return [by[:n] for n in range(len(by), -1, -1)]


# --- sales ------------------------------------------------------------------
def _sales() -> dict[str, Column]:
    net, profit = F.sum("NetSales"), F.sum("GrossProfit")
    return {
        "TotalNetSales": net,
        "TotalGrossProfit": profit,
        "GrossMarginShare": safe_divide(profit, net),
        "AvgOrderValue": safe_divide(net, F.count_distinct("OrderCount")),
    }


def sales_measures(summary: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Net sales, gross profit, margin and average order value of the sales summary.

    ``AvgOrderValue`` divides by the number of different ``OrderCount`` values,
    which is how the report defines it; :func:`avg_order_value` divides by orders.
    """
    return _evaluate(summary, _sales(), by)


def sales_report(summary: DataFrame, contexts: list[list[str]]) -> DataFrame:
    return _in_contexts(summary, _sales(), contexts)


def avg_order_value(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Net sales per distinct order."""
    orders = F.count_distinct("OrderID")
    return _evaluate(fact, {"Orders": orders, "AvgOrderValueTrue": safe_divide(F.sum("NetSales"), orders)}, by)


def sales_yoy(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Net sales per month against the same month one year before.

    ``daily`` has ``FullDate`` and ``NetSales``.  The prior month comes from a
    range frame over the year, so gaps in the years do not shift it.
    """
    by = by or []
    months = daily.groupBy(*by, F.year("FullDate").alias("Year"), F.month("FullDate").alias("MonthNumber")).agg(
        F.sum("NetSales").alias("NetSales")
    )
    year_before = Window.partitionBy(*by, "MonthNumber").orderBy("Year").rangeBetween(-1, -1)
    prior = F.col("PriorNetSales")
    return months.withColumn("PriorNetSales", F.sum("NetSales").over(year_before)).withColumn(
        "YoYChange", safe_divide(F.col("NetSales") - prior, prior)
    )


def sales_ytd(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Net sales per day and running total since the first of January."""
    by = by or []
    days = daily.groupBy(*by, "FullDate").agg(F.sum("NetSales").alias("NetSales"))
    running = (
        Window.partitionBy(*by, "Year").orderBy("FullDate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return days.withColumn("Year", F.year("FullDate")).withColumn("YTDNetSales", F.sum("NetSales").over(running))


def revenue_target(targets: DataFrame, as_of: dt.date) -> DataFrame:
    """Target of the month of ``as_of``; one row."""
    month = (F.col("Month") == as_of.month) & (F.col("Year") == as_of.year)
    return targets.filter(month).agg(F.sum("MonthlyTarget").alias("RevenueTarget"))


def target_attainment(
    sales: DataFrame, targets: DataFrame, as_of: dt.date, by: list[str] | None = None
) -> DataFrame:
    """Net sales of ``sales`` against the target of the month of ``as_of``."""
    net = _evaluate(sales, {"TotalNetSales": F.sum("NetSales")}, by)
    return net.withColumn("RevenueTarget", revenue_target(targets, as_of).scalar()).withColumn(
        "TargetAttainment", safe_divide(F.col("TotalNetSales"), F.col("RevenueTarget"))
    )


# --- churn ------------------------------------------------------------------
def _churn() -> dict[str, Column]:
    category = F.col("ChurnRiskCategory")
    at_risk = F.sum(F.when(category.isin("High", "Medium"), F.col("RevenueAtRisk")))
    return {
        "HighRiskCustomers": F.count_if(category == "High"),
        "TotalRevenueAtRisk": at_risk,
        "AvgChurnRiskScore": F.avg("ChurnRiskScore"),
        "RetentionUplift": at_risk * F.lit(V.RETENTION_UPLIFT),
        "AvgDaysSincePurchase": F.avg("DaysSinceLastPurchase"),
    }


def churn_measures(dashboard: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Customers and revenue at risk; here both high and medium risk count as revenue at risk."""
    return _evaluate(dashboard, _churn(), by)


def churn_report(dashboard: DataFrame, contexts: list[list[str]]) -> DataFrame:
    return _in_contexts(dashboard, _churn(), contexts)


def churn_category_share(
    dashboard: DataFrame, shown: DataFrame | None = None, by: list[str] | None = None
) -> DataFrame:
    """Customers per risk category, next to the category's count without any other filter.

    ``shown`` is the filtered part of ``dashboard`` that a report displays.
    """
    shown = dashboard if shown is None else shown
    category = "ChurnRiskCategory"
    # A handful of categories: counted before the join, so no category is one big group.
    everywhere = dashboard.groupBy(category).agg(F.count(F.lit(1)).alias("CategoryCustomers"))
    here = shown.groupBy(*(by or []), category).agg(F.count(F.lit(1)).alias("Customers"))
    same = here[category].eqNullSafe(everywhere[category])
    return here.join(everywhere, same).select(*[here[c] for c in here.columns], "CategoryCustomers")


# --- inventory --------------------------------------------------------------
def _inventory() -> dict[str, Column]:
    days = F.col("DaysOfSupply")
    return {
        "TotalInventoryValue": F.sum("InventoryValue"),
        "TotalOverstockCost": F.sum("OverstockCost"),
        "HighStockOutSKUs": F.count_if(F.col("StockOutRisk") == "High"),
        "AvgDaysOfSupply": F.avg(F.when(days < V.NO_SALES_DAYS_OF_SUPPLY, days)),
        "OverstockRate": safe_divide(
            F.count_if(F.col("OverstockFlag")).cast("double"), F.count(F.lit(1)).cast("double")
        ),
    }


def inventory_measures(intelligence: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stock value, excess cost, stock-outs, days of supply and overstock rate (a fraction)."""
    return _evaluate(intelligence, _inventory(), by)


def inventory_report(intelligence: DataFrame, contexts: list[list[str]]) -> DataFrame:
    return _in_contexts(intelligence, _inventory(), contexts)
