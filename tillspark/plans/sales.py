"""Sales reports on the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark import fixed_values as V
from tillspark.functions.dates import date_key_of, month_bounds
from tillspark.functions.money import guarded_ratio, percent_of
from tillspark.operators.grouping import group_codes
from tillspark.operators.joins import if_few, lookup
from tillspark.operators.ranking import top_rows
from tillspark.sources.warehouse import MONTH

DATE_COLUMNS = ["Year", "Quarter", "MonthNumber", "MonthName", "FullDate"]
STORE_COLUMNS = ["Region", "State", "StoreType"]
PRODUCT_COLUMNS = ["Category", "SubCategory", "Brand"]


def kept_sales(fact: DataFrame) -> DataFrame:
    """Sales without returns."""
    return fact.filter(~F.col("ReturnFlag"))


def between_keys(fact: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Sales of a range of date keys.

    The stored fact is partitioned by month, so the month is filtered as well
    and whole folders are skipped.
    """
    key = F.col("DateKey")
    inside = key >= first if last is None else key.between(first, last)
    if MONTH in fact.columns:
        month = F.col(MONTH)
        inside &= month >= first // 100 if last is None else month.between(first // 100, last // 100)
    return fact.filter(inside)


def current_month(fact: DataFrame, as_of: dt.date) -> DataFrame:
    return between_keys(fact, *month_bounds(as_of))


def since(fact: DataFrame, day: dt.date) -> DataFrame:
    return between_keys(fact, date_key_of(day))


def _sales_totals() -> dict[str, Column]:
    return {
        "GrossSales": F.sum("GrossSales"),
        "NetSales": F.sum("NetSales"),
        "GrossProfit": F.sum("GrossProfit"),
        "UnitsSold": F.sum("Quantity"),
        "OrderCount": F.count_distinct("OrderID"),
        "UniqueCustomers": F.count_distinct("CustomerKey"),
    }


def sales_summary(
    fact: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Sales without returns per day, place, product group and customer segment."""
    return described_days(sales_groups(fact, stores, products, customers), dates)


def sales_groups(fact: DataFrame, stores: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """The groups of the sales summary with the key of their day.

    The sales carry codes for the store and product columns and the key of the
    day while they are grouped; the descriptive columns are joined to the groups
    afterwards.
    """
    store_codes, store_groups = group_codes(stores, "StoreKey", STORE_COLUMNS, "StoreGroup")
    product_codes, product_groups = group_codes(products, "ProductKey", PRODUCT_COLUMNS, "ProductGroup")
    sales = kept_sales(fact).join(if_few(product_codes, products), "ProductKey")
    sales = sales.join(if_few(store_codes, stores), "StoreKey")
    sales = lookup(
        sales, customers.select("CustomerKey", F.col("Segment").alias("CustomerSegment")), "CustomerKey"
    )
    groups = _group_totals(sales, ["DateKey", "StoreGroup", "ProductGroup", "CustomerSegment"])
    described = lookup(groups, store_groups, "StoreGroup")
    described = lookup(described, product_groups, "ProductGroup")
    return described.select("DateKey", *STORE_COLUMNS, *PRODUCT_COLUMNS, "CustomerSegment", *_sales_totals())


def _group_totals(sales: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`_sales_totals` per group, from one shuffle of the sales.

    Two distinct counts in one grouping make Spark copy every sale three times
    and shuffle the copies twice.  Here the sales of a group meet once, in their
    narrow form; the first line of each order and of each customer counts it.  A
    group has sales of one day only, which are sorted and may spill.
    """
    needed = sales.select(*keys, "OrderID", "CustomerKey", "GrossSales", "NetSales", "GrossProfit", "Quantity").repartition(*keys)

    def first(column: str) -> Column:
        return (F.row_number().over(Window.partitionBy(*keys, column).orderBy(column)) == 1) & F.col(column).isNotNull()

    marked = needed.withColumn("FirstOfOrder", first("OrderID")).withColumn("FirstOfCustomer", first("CustomerKey"))
    totals = _sales_totals() | {"OrderCount": F.count_if("FirstOfOrder"), "UniqueCustomers": F.count_if("FirstOfCustomer")}
    return marked.groupBy(*keys).agg(*[c.alias(name) for name, c in totals.items()])


def described_days(groups: DataFrame, dates: DataFrame) -> DataFrame:
    """The sales summary from its groups."""
    return lookup(groups, dates.select("DateKey", *DATE_COLUMNS), "DateKey").select(
        *DATE_COLUMNS,
        *STORE_COLUMNS,
        *PRODUCT_COLUMNS,
        "CustomerSegment",
        *_sales_totals(),
        percent_of(F.col("GrossProfit"), F.col("NetSales")).alias("GrossMarginPct"),
    )


def kpi_summary(
    fact: DataFrame, customers: DataFrame, churn: DataFrame, inventory: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row of key figures for the month of ``as_of``, also when nothing was sold."""
    month = kept_sales(current_month(fact, as_of)).agg(
        F.sum("NetSales").alias("TotalRevenue"),
        F.sum("GrossProfit").alias("TotalGrossProfit"),
        F.count_distinct("OrderID").alias("TotalOrders"),
        F.count_distinct("CustomerKey").alias("ActiveCustomers"),
    )
    return kpi_row(month, customers, churn, inventory)


def kpi_row(month: DataFrame, customers: DataFrame, churn: DataFrame, inventory: DataFrame) -> DataFrame:
    """Key figures from one row of the month's sales totals."""
    is_high = F.col("ChurnRiskCategory") == "High"
    high_customers = customers.filter(is_high & F.col("IsActive")).agg(F.count(F.lit(1)))
    at_risk = churn.filter(is_high).agg(F.sum("RevenueAtRisk"))
    stock_outs = inventory.filter(F.col("StockOutRisk") == "High").agg(F.count(F.lit(1)))
    revenue = F.col("TotalRevenue")
    return month.select(
        F.lit(V.KPI_PERIOD).alias("Period"),
        "TotalRevenue",
        "TotalGrossProfit",
        percent_of(F.col("TotalGrossProfit"), revenue).alias("GrossMarginPct"),
        "TotalOrders",
        "ActiveCustomers",
        guarded_ratio(revenue, F.col("ActiveCustomers")).alias("AvgRevenuePerCustomer"),
        high_customers.scalar().alias("HighChurnCustomers"),
        at_risk.scalar().alias("TotalRevenueAtRisk"),
        stock_outs.scalar().alias("HighStockOutSKUs"),
    )


def top_product_groups(fact: DataFrame, products: DataFrame, as_of: dt.date, n: int = V.TOP_ROWS) -> DataFrame:
    """Best selling product groups of the month of ``as_of``.

    The sums are additive, so they are taken from the fact directly; products
    are counted per key before the lookup.
    """
    month = kept_sales(current_month(fact, as_of))
    per_product = month.groupBy("ProductKey").agg(
        F.sum("NetSales").alias("NetSales"),
        F.sum("GrossProfit").alias("GrossProfit"),
        F.sum("Quantity").alias("UnitsSold"),
    )
    groups = (
        lookup(per_product, products.select("ProductKey", "Category", "SubCategory"), "ProductKey")
        .groupBy("Category", "SubCategory")
        .agg(*[F.sum(c).alias(c) for c in ("NetSales", "GrossProfit", "UnitsSold")])
    )
    return top_rows(groups, [F.desc("NetSales"), F.asc("Category"), F.asc("SubCategory")], n)
