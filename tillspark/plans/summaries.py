"""Sales reports from stored totals per day, so that a report reads groups and a batch costs only its own days.

Four tables are partitioned by day: the groups of the sales summary, and per region
the sums, the different orders, and bitmaps of the different customers.  Sums add up
over days, orders and bitmaps merge, so figures of any period are exact.  Orders are
kept by name, as they have no numbers that a bitmap could hold.

``refresh`` rewrites the days that may have changed: those of batches published since
the last time, of attempts that a replay has replaced, and those with sales of a
store, product or customer whose group is another one now.  A day is rewritten from
all its sales.  What the tables cover is written last, so a refresh that breaks off
is repaired by the next one.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.functions.dates import month_bounds, month_of_key
from tillspark.operators.bitmaps import count_numbers, number_bitmaps
from tillspark.operators.joins import if_small, lookup
from tillspark.plans import sales
from tillspark.plans.access import visible_to
from tillspark.sources.warehouse import ATTEMPT, BATCH, MONTH, SNAPSHOT_TABLES, Warehouse

#: Dimensions that give sales their groups: table, key and the columns that form groups.
GROUPED = {
    "DimStore": ("StoreKey", sales.STORE_COLUMNS),
    "DimProduct": ("ProductKey", sales.PRODUCT_COLUMNS),
    "DimCustomer": ("CustomerKey", ["Segment"]),
}
#: A column of each table that no row lacks but the mark of a day.
FILLED = {"SalesGroups": "OrderCount", "SalesRegions": "Lines", "SalesOrders": "OrderID", "SalesCustomers": "Bits"}


def refresh(warehouse: Warehouse) -> list[int]:
    """Bring the stored totals up to the published sales and the current dimensions; returns the days rewritten.

    Days are bounded by the calendar.  One writer at a time, as for other tables.
    """
    fact = warehouse.read("FactSales")
    published, covered = warehouse._published("FactSales"), warehouse.read("SummaryBatches")
    batch = [BATCH, ATTEMPT]
    new = published.join(if_small(covered.select(*batch).distinct()), batch, "left_anti")
    new_days = fact.join(if_small(new.select(BATCH)), BATCH, "left_semi").select(BATCH, "DateKey").distinct()
    # A batch without sales is covered too, by a row without a day.
    added = warehouse.staged("SummaryBatchesNew", new.join(new_days, BATCH, "left").select(*batch, "DateKey"))
    gone = covered.join(if_small(published), batch, "left_anti")
    keys = warehouse.staged("SummaryKeysNew", _compared_keys(warehouse))

    touched = [added.select("DateKey"), gone.select("DateKey")]
    changed = keys.filter("Changed")
    if not changed.isEmpty():
        for table, (key, _) in GROUPED.items():
            moved = changed.filter(F.col("DimTable") == table).select(F.col("Key").alias(key))
            touched.append(fact.join(if_small(moved), key, "left_semi").select("DateKey"))
    found = reduce(DataFrame.unionByName, touched).filter("DateKey IS NOT NULL").distinct()
    days = sorted(row[0] for row in found.collect())
    if days:
        _rewrite(warehouse, fact, days)
    if not keys.filter("Changed OR Added").isEmpty():
        warehouse.replace("SummaryKeys", keys)
    if not added.isEmpty() or not gone.isEmpty():
        kept = covered.join(if_small(published), batch, "left_semi")
        warehouse.replace("SummaryBatches", kept.unionByName(added))
    return days


def _compared_keys(warehouse: Warehouse) -> DataFrame:
    """Every key ever covered with its group now, whether it is present, added since, or changed.

    A key that is removed stays known, so that its return is a change.
    """

    def now(table: str, key: str, columns: list[str]) -> DataFrame:
        groups = F.array(*columns).alias("GroupsNow")
        return warehouse.read(table).select(F.lit(table).alias("DimTable"), F.col(key).alias("Key"), groups, F.lit(True).alias("Now"))

    current = reduce(DataFrame.unionByName, [now(table, *columns) for table, columns in GROUPED.items()])
    both = warehouse.read("SummaryKeys").join(current, ["DimTable", "Key"], "full")
    present, known = F.col("Now").isNotNull(), F.col("Present").isNotNull()
    moved = present & ~F.col("Groups").eqNullSafe(F.col("GroupsNow"))
    return both.select(
        "DimTable",
        "Key",
        F.when(present, F.col("GroupsNow")).otherwise(F.col("Groups")).alias("Groups"),
        present.alias("Present"),
        (~known).alias("Added"),
        (known & (moved | (F.col("Present") != present))).alias("Changed"),
    )


def _rewrite(warehouse: Warehouse, fact: DataFrame, days: list[int]) -> None:
    """Write the totals of whole days; a day that has no sales left gets its mark only."""
    own = fact.filter(F.col(MONTH).isin(sorted({d // 100 for d in days})) & F.col("DateKey").isin(days))
    placed = lookup(sales.kept_sales(own), warehouse.read("DimStore").select("StoreKey", "Region"), "StoreKey", "left")
    by = ["DateKey", "Region"]
    sums = [F.sum("NetSales").alias("NetSales"), F.sum("GrossProfit").alias("GrossProfit"), F.count(F.lit(1)).alias("Lines")]
    groups = sales.sales_groups(own, warehouse.read("DimStore"), warehouse.read("DimProduct"), warehouse.read("DimCustomer"))
    frames = {
        "SalesGroups": groups,
        "SalesRegions": placed.groupBy(*by).agg(*sums),
        "SalesOrders": placed.select(*by, "OrderID").distinct(),
        "SalesCustomers": number_bitmaps(placed, by, "CustomerKey"),
    }
    mark = warehouse.spark.createDataFrame([(d,) for d in days], "DateKey int")
    for name, frame in frames.items():
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in SNAPSHOT_TABLES[name] if f.name != "DateKey"]
        warehouse.put_snapshot(name, frame.unionByName(mark.select("DateKey", *empty)))


def _stored(warehouse: Warehouse, name: str, principal: str | None, role: str) -> DataFrame:
    rows = warehouse.read(name).filter(F.col(FILLED[name]).isNotNull())
    return rows if principal is None else visible_to(rows, warehouse.read("UserRegions"), principal, role)


def sales_summary(warehouse: Warehouse, principal: str | None = None, role: str = "RegionManagers") -> DataFrame:
    """The sales summary as of the last refresh; reads no sales."""
    return sales.described_days(_stored(warehouse, "SalesGroups", principal, role), warehouse.read("DimDate"))


def period_totals(
    warehouse: Warehouse,
    first: int,
    last: int,
    by: list[str] | None = None,
    principal: str | None = None,
    role: str = "RegionManagers",
) -> DataFrame:
    """Net sales, profit, different orders and different customers between two date keys.

    ``by`` may name DateKey, SaleMonth and Region; without it there is one row, also when nothing was sold.
    """
    by = by or []

    def stored(name: str) -> DataFrame:
        rows = _stored(warehouse, name, principal, role).filter(F.col("DateKey").between(first, last))
        return rows.withColumn(MONTH, month_of_key(F.col("DateKey")))

    parts = [
        stored("SalesRegions").groupBy(*by).agg(F.sum("NetSales").alias("TotalRevenue"), F.sum("GrossProfit").alias("TotalGrossProfit")),
        stored("SalesOrders").groupBy(*by).agg(F.count_distinct("OrderID").alias("TotalOrders")),
        count_numbers(stored("SalesCustomers"), by, "ActiveCustomers"),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy(*by).agg(
        F.sum("TotalRevenue").alias("TotalRevenue"),
        F.sum("TotalGrossProfit").alias("TotalGrossProfit"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("TotalOrders", "ActiveCustomers")],
    )


def kpi_summary(
    warehouse: Warehouse,
    as_of: dt.date,
    customers: DataFrame,
    churn: DataFrame,
    inventory: DataFrame,
    principal: str | None = None,
    role: str = "RegionManagers",
) -> DataFrame:
    """The KPI summary with the month's sales as of the last refresh; the other frames are restricted by the caller."""
    month = period_totals(warehouse, *month_bounds(as_of), principal=principal, role=role)
    return sales.kpi_row(month, customers, churn, inventory)
