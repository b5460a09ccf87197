"""One key holds a third of all rows: results stay whole, and the hot key is split."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import schemas as S
from tillspark.plans import customers, inventory, sales, sales_load
from tillspark.plans.calendar import calendar_between

AS_OF = dt.date(2026, 3, 31)
ROWS = 60_000
SHUFFLING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


class SkewedStar:
    def __init__(self, spark, folder):
        def stored(df, name):
            df.write.parquet(f"{folder}/{name}")
            return spark.read.parquet(f"{folder}/{name}")

        def hot(column, n):
            return f"CASE WHEN id % 3 = 0 THEN 1 ELSE 1 + {column} % {n} END"

        keys = spark.range(0, ROWS, 1, 8).selectExpr(
            "id",
            f"{hot('id', 500)} AS CustomerKey",
            f"{hot('id', 70)} AS ProductKey",
            f"{hot('id', 20)} AS StoreKey",
            f"CAST({hot('(id div 2)', 9000)} AS STRING) AS OrderID",
            "CAST(id AS INT) AS OrderLineID",
            "20260101 + CAST(id % 3 AS INT) * 100 + CAST(id % 28 AS INT) AS DateKey",
            "CAST(1 + id % 5 AS INT) AS Quantity",
            "CAST(10 + id % 90 AS DECIMAL(10,2)) AS UnitPrice",
            "CAST(id % 20 AS DECIMAL(5,2)) AS Discount",
            "CAST(5 AS DECIMAL(10,2)) AS COGS",
            "id % 11 = 0 AS ReturnFlag",
        )
        self.fact = stored(sales_load.with_measures(keys).select(S.FACT_SALES.fieldNames()), "fact")
        self.dates = calendar_between(spark, "2026-01-01", "2026-12-31")
        self.customers = stored(
            spark.range(1, 600).selectExpr(
                "id AS CustomerKey", "concat('C', id) AS CustomerID", "true AS IsActive",
                "CASE WHEN id % 2 = 0 THEN 'Premium' ELSE 'Regular' END AS Segment"), "customers")
        self.products = stored(
            spark.range(1, 80).selectExpr(
                "id AS ProductKey", "concat('P', id) AS ProductID", "concat('Cat', id % 6) AS Category",
                "concat('Sub', id % 13) AS SubCategory", "CASE WHEN id % 5 > 0 THEN concat('B', id % 5) END AS Brand",
                "CAST(5 AS DECIMAL(10,2)) AS UnitCost"), "products")
        self.stores = stored(
            spark.range(1, 25).selectExpr(
                "id AS StoreKey", "concat('S', id) AS StoreID", "concat('R', id % 4) AS Region",
                "concat('St', id % 7) AS State", "'Physical' AS StoreType"), "stores")
        self.tickets = spark.createDataFrame([], S.SUPPORT_TICKETS)
        self.raw = stored(
            self.fact.selectExpr(
                "CASE WHEN OrderLineID % 50 <> 7 THEN OrderID END AS OrderID", "OrderLineID",
                "concat('C', CustomerKey) AS CustomerID", "concat('P', ProductKey) AS ProductID",
                "concat('S', StoreKey) AS StoreID",
                "make_date(2026, CAST(DateKey / 100 AS INT) % 100, DateKey % 100) AS OrderDate",
                "Quantity", "UnitPrice", "Discount", "ReturnFlag"), "raw")


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    return SkewedStar(spark, str(tmp_path_factory.mktemp("skewed")))


@pytest.fixture
def shuffling(spark):
    """Take broadcasting away and make small partitions count as skewed."""
    before = {k: spark.conf.get(k, None) for k in SHUFFLING}
    for k, v in SHUFFLING.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def queries(t):
    loaded = t.fact.filter("OrderLineID % 4 = 0")
    return {
        "summary": lambda: sales.sales_summary(t.fact, t.dates, t.stores, t.products, t.customers),
        "activity": lambda: customers.customer_activity(
            t.customers, t.fact, t.dates, t.products, t.tickets, AS_OF
        ),
        "facts": lambda: sales_load.new_facts(t.raw, t.customers, t.products, t.stores, loaded),
        "outcomes": lambda: sales_load.outcome_counts(
            sales_load.outcomes(t.raw, t.customers, t.products, t.stores, loaded)
        ),
        "rates": lambda: inventory.avg_daily_sales(t.fact, AS_OF),
    }


def test_shuffled_and_broadcast_plans_agree(spark, star, shuffling):
    shuffled = {name: sorted(q().collect(), key=str) for name, q in queries(star).items()}
    for k in SHUFFLING:
        spark.conf.unset(k)
    for name, q in queries(star).items():
        assert sorted(q().collect(), key=str) == shuffled[name], name


def test_the_hot_key_is_split(spark, star, shuffling):
    facts = sales_load.new_facts(
        star.raw, star.customers, star.products, star.stores, star.fact.filter("OrderLineID % 4 = 0")
    )
    facts.collect()
    text = facts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text
    assert "skew=true" in text


def test_totals_of_the_hot_customer(star):
    activity = customers.customer_activity(
        star.customers, star.fact, star.dates, star.products, star.tickets, AS_OF
    )
    row = activity.filter("CustomerKey = 1").first()
    mine = star.fact.filter("CustomerKey = 1").toPandas()
    assert len(mine) > ROWS / 3
    assert row.TotalOrders == mine.OrderID.nunique()
    assert row.TotalSpend == sum(mine.NetSales, Decimal(0)).quantize(Decimal("0.01"), "ROUND_HALF_UP")


def test_summary_counts_every_kept_row(star):
    summary = sales.sales_summary(star.fact, star.dates, star.stores, star.products, star.customers)
    units, net = summary.agg(F.sum("UnitsSold"), F.sum("NetSales")).first()
    expected = star.fact.filter("NOT ReturnFlag").agg(F.sum("Quantity"), F.sum("NetSales")).first()
    assert (units, net) == tuple(expected)
    keys = ["DateKey", "Region", "State", "StoreType", "Category", "SubCategory", "Brand", "Segment"]
    plain = (
        star.fact.filter("NOT ReturnFlag").join(star.stores, "StoreKey").join(star.products, "ProductKey")
        .join(star.customers, "CustomerKey").groupBy(keys)
        .agg(F.count_distinct("OrderID").alias("o"), F.count_distinct("CustomerKey").alias("c"))
    )
    assert summary.count() == plain.count()
    assert tuple(summary.agg(F.sum("OrderCount"), F.sum("UniqueCustomers")).first()) == tuple(
        plain.agg(F.sum("o"), F.sum("c")).first()
    )
