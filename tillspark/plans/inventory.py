"""Inventory snapshots and what they say."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import fixed_values as V
from tillspark.functions.dates import date_key_of
from tillspark.functions.rules import days_of_supply, is_overstocked, overstock_cost, stock_out_risk
from tillspark.operators.joins import if_few, lookup
from tillspark.operators.ranking import top_rows
from tillspark.plans.sales import since
from tillspark.schemas import FACT_INVENTORY

STOCK_KEY = ["ProductKey", "StoreKey"]


def avg_daily_sales(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Units per day and product-store pair over the last 30 days; returns count as sales."""
    window = since(fact, as_of - dt.timedelta(days=V.SALES_WINDOW_DAYS))
    per_day = F.sum("Quantity").cast("double") / F.lit(float(V.SALES_WINDOW_DAYS))
    return window.groupBy(*STOCK_KEY).agg(per_day.alias("AvgDailySales"))


def inventory_snapshot(
    stock: DataFrame, products: DataFrame, stores: DataFrame, fact: DataFrame, as_of: dt.date
) -> DataFrame:
    """Stock of ``as_of`` with days of supply, stock-out risk and overstock flag."""
    keyed = stock.join(if_few(products.select("ProductID", "ProductKey")), "ProductID")
    keyed = keyed.join(if_few(stores.select("StoreID", "StoreKey")), "StoreID")
    joined = keyed.join(avg_daily_sales(fact, as_of), STOCK_KEY, "left")
    on_hand, reorder = F.col("QuantityOnHand"), F.col("ReorderPoint")
    columns = {
        "DateKey": F.lit(date_key_of(as_of)),
        "ProductKey": F.col("ProductKey"),
        "StoreKey": F.col("StoreKey"),
        "QuantityOnHand": on_hand,
        "ReorderPoint": reorder,
        "DaysOfSupply": days_of_supply(on_hand, F.col("AvgDailySales")),
        "StockOutRisk": stock_out_risk(on_hand, reorder),
        "OverstockFlag": is_overstocked(on_hand, reorder),
    }
    return joined.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in FACT_INVENTORY])


def inventory_intelligence(
    inventory: DataFrame, products: DataFrame, stores: DataFrame, dates: DataFrame
) -> DataFrame:
    """The latest snapshot with stock value and cost of excess stock.

    Snapshots are partitioned by ``DateKey``: the latest key is a scalar
    subquery on it, and only its folder is scanned.
    """
    day_keys = lookup(inventory.select("DateKey").distinct(), dates.select("DateKey", "FullDate"), "DateKey")
    latest_key = day_keys.agg(F.max_by("DateKey", "FullDate")).scalar()
    latest = inventory.filter(F.col("DateKey") == latest_key)
    joined = lookup(
        latest,
        products.select("ProductKey", "ProductID", "ProductName", "Category", "SubCategory", "Brand", "UnitCost"),
        "ProductKey",
    )
    joined = lookup(
        joined, stores.select("StoreKey", "StoreName", "Region", "State", "StoreType"), "StoreKey"
    )
    joined = lookup(joined, dates.select("DateKey", "FullDate"), "DateKey")
    cost, on_hand, reorder = F.col("UnitCost"), F.col("QuantityOnHand"), F.col("ReorderPoint")
    return joined.select(
        "ProductID",
        "ProductName",
        "Category",
        "SubCategory",
        "Brand",
        "StoreName",
        "StoreType",
        "Region",
        "State",
        "QuantityOnHand",
        "ReorderPoint",
        "DaysOfSupply",
        "StockOutRisk",
        "OverstockFlag",
        (cost * on_hand).alias("InventoryValue"),
        overstock_cost(F.col("OverstockFlag"), cost, on_hand, reorder).alias("OverstockCost"),
        F.col("FullDate").alias("SnapshotDate"),
    )


def inventory_alerts(intelligence: DataFrame, n: int = V.TOP_ROWS) -> DataFrame:
    """Stock that runs out first among the lines at high or medium risk."""
    at_risk = intelligence.filter(F.col("StockOutRisk").isin("High", "Medium"))
    order = [F.asc("DaysOfSupply"), F.asc("ProductID"), F.asc("StoreName")]
    return top_rows(at_risk, order, n).select(
        "ProductID",
        "ProductName",
        "Category",
        "StoreName",
        "StoreType",
        "QuantityOnHand",
        "DaysOfSupply",
        "StockOutRisk",
    )
