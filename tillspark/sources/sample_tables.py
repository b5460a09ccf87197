"""The star schema and its staging tables derived from the sample order tables.

Keys of the sample tables serve as surrogate keys, their text form as business
keys.  Orders after ``as_of`` are not known yet and are left out.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark import schemas as S
from tillspark.fixed_values import INSIGHT_AREAS
from tillspark.functions.dates import date_key
from tillspark.functions.money import MONEY, unit_margin_percent
from tillspark.functions.rules import churn_category
from tillspark.operators.joins import if_few, if_small, scanned_bytes
from tillspark.plans.calendar import calendar_between
from tillspark.plans.sales_load import with_measures
from tillspark.session import size_shuffles

# Column types of the sample tables, stated so that opening a table starts no job.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "conversations": "conv_id long, turn long, role string, text string",
}

AS_OF = dt.date(2001, 7, 31)
CALENDAR = ("1992-01-01", "2002-12-31")
HISTORY_END = dt.date(1998, 1, 1)
TARGET_GROWTH = "1.10"
#: Orders of a period up to this number are broadcast; keys and dates of a million take some 60 MB.
FEW_ORDERS = 1_000_000
_PROBABILITY = "CAST(CAST({} * 37 % 10000 AS DECIMAL(10,0)) * 0.0001BD AS DECIMAL(5,4))"


def _on_day(column: str, comparison: str, day: dt.date) -> str:
    """Comparison on the stored timestamp, so that it reaches the scan."""
    return f"{column} {comparison} TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'"


class SampleTables:
    """Lazily built frames over one folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str, as_of: dt.date = AS_OF):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.as_of = as_of
        size_shuffles(spark, scanned_bytes(self.table("lineitem")))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- dimensions ---------------------------------------------------------
    @cached_property
    def dates(self) -> DataFrame:
        return calendar_between(self.spark, *CALENDAR)

    @cached_property
    def geography(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        joined = nation.join(if_small(region), nation["n_regionkey"] == region["r_regionkey"])
        return joined.selectExpr("n_nationkey", "n_name AS State", "r_name AS Region")

    def _placed(self, table: str, nation_key: str) -> DataFrame:
        rows = self.table(table)
        return rows.join(if_small(self.geography), rows[nation_key] == self.geography["n_nationkey"])

    @cached_property
    def stores(self) -> DataFrame:
        return self._placed("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS StoreKey",
            "CAST(s_suppkey AS STRING) AS StoreID",
            "s_name AS StoreName",
            "Region",
            "State",
            "State AS City",
            "CASE s_suppkey % 3 WHEN 0 THEN 'Physical' WHEN 1 THEN 'Online' ELSE 'Outlet' END AS StoreType",
            "date_add(DATE '1990-01-01', CAST(s_suppkey % 1000 AS INT)) AS OpenDate",
            "true AS IsActive",
        )

    @cached_property
    def products(self) -> DataFrame:
        priced = self.table("part").selectExpr(
            "*",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice",
            "CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60BD, 2) AS DECIMAL(10,2)) AS UnitCost",
        )
        return priced.select(
            F.col("p_partkey").alias("ProductKey"),
            F.col("p_partkey").cast("string").alias("ProductID"),
            F.col("p_name").alias("ProductName"),
            F.col("p_type").alias("Category"),
            F.col("p_name").alias("SubCategory"),
            F.col("p_brand").alias("Brand"),
            "UnitCost",
            "UnitPrice",
            unit_margin_percent(F.col("UnitPrice"), F.col("UnitCost")).alias("GrossMarginPct"),
            F.lit(True).alias("IsActive"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers that have not been scored yet."""
        return self._placed("customer", "c_nationkey").selectExpr(
            "c_custkey AS CustomerKey",
            "CAST(c_custkey AS STRING) AS CustomerID",
            "split_part(c_name, '#', 1) AS FirstName",
            "split_part(c_name, '#', 2) AS LastName",
            "concat('c', c_custkey, '@mail.example') AS Email",
            "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Premium'"
            " WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Regular' ELSE 'At-Risk' END AS Segment",
            "Region",
            "State",
            "State AS City",
            "CAST(NULL AS STRING) AS ZipCode",
            "date_add(DATE '1994-01-01', CAST(c_custkey % 365 AS INT)) AS JoinDate",
            "c_acctbal >= 0 AS IsActive",
            "CAST(NULL AS DECIMAL(5,4)) AS ChurnRiskScore",
            "CAST(NULL AS STRING) AS ChurnRiskCategory",
            "CAST(NULL AS DATE) AS LastScoredDate",
        )

    @cached_property
    def churn_scores(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("CustomerID"),
            F.expr(_PROBABILITY.format("c_custkey")).alias("ChurnProbability"),
            F.lit(self.as_of).alias("ScoredDate"),
        )

    @cached_property
    def scored_customers(self) -> DataFrame:
        """Customers with the scores of :attr:`churn_scores`, computed in place."""
        return (
            self.customers.withColumn("ChurnRiskScore", F.expr(_PROBABILITY.format("CustomerKey")))
            .withColumn("ChurnRiskCategory", churn_category(F.col("ChurnRiskScore")))
            .withColumn("LastScoredDate", F.lit(self.as_of))
        )

    # --- facts --------------------------------------------------------------
    def order_lines(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Order lines with their order's customer and date, and price and cost of the product."""
        orders = self.table("orders").filter(_on_day("o_orderdate", "<", self.as_of + dt.timedelta(days=1)))
        if since is not None:
            orders = orders.filter(_on_day("o_orderdate", ">=", since))
        if before is not None:
            orders = orders.filter(_on_day("o_orderdate", "<", before))
        if since is not None and orders.count() <= FEW_ORDERS:
            # How few they are shows only after the filter: planned without that, all lines would be shuffled.
            orders = F.broadcast(orders)
        dated = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        lines = dated.selectExpr(
            "l_orderkey",
            "l_linenumber AS OrderLineID",
            "o_custkey AS CustomerKey",
            "l_partkey AS ProductKey",
            "l_suppkey AS StoreKey",
            "CAST(o_orderdate AS DATE) AS OrderDate",
            "CAST(l_quantity AS INT) AS Quantity",
            "CAST(CAST(round(l_discount * 100) AS INT) AS DECIMAL(5,2)) AS Discount",
            "l_returnflag",
        )
        return lines.join(if_few(self.products.select("ProductKey", "UnitPrice", "UnitCost")), "ProductKey")

    def sales(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Loaded sales fact."""
        sales = self.order_lines(since, before).select(
            F.col("l_orderkey").cast("string").alias("OrderID"),
            "OrderLineID",
            date_key(F.col("OrderDate")).alias("DateKey"),
            "CustomerKey",
            "ProductKey",
            "StoreKey",
            "Quantity",
            "UnitPrice",
            "Discount",
            (F.col("UnitCost") * F.col("Quantity")).cast(MONEY).alias("COGS"),
            (F.col("l_returnflag") == "R").alias("ReturnFlag"),
        )
        return with_measures(sales)

    @cached_property
    def all_sales(self) -> DataFrame:
        return self.sales()

    # --- staging ------------------------------------------------------------
    @cached_property
    def sales_raw(self) -> DataFrame:
        """Sales staging with faults put in by rule, so that every outcome occurs."""
        return self.order_lines().selectExpr(
            "CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS STRING) END AS OrderID",
            "OrderLineID",
            "CASE WHEN l_orderkey % 79 = 0 THEN 'unknown' ELSE CAST(CustomerKey AS STRING) END AS CustomerID",
            "CASE WHEN l_orderkey % 73 = 0 THEN 'unknown' ELSE CAST(ProductKey AS STRING) END AS ProductID",
            "CASE WHEN l_orderkey % 71 = 0 THEN 'unknown' ELSE CAST(StoreKey AS STRING) END AS StoreID",
            "OrderDate",
            "CASE WHEN l_orderkey % 89 = 0 THEN 0 WHEN l_orderkey % 83 <> 0 THEN Quantity END AS Quantity",
            "CAST(CASE WHEN l_orderkey % 101 = 0 THEN -UnitPrice ELSE UnitPrice END AS DECIMAL(10,2)) AS UnitPrice",
            "nullif(Discount, 0) AS Discount",
            "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS ReturnFlag",
            "false AS ProcessedFlag",
            "CAST(NULL AS TIMESTAMP) AS ProcessedDate",
        )

    @cached_property
    def loaded_history(self) -> DataFrame:
        """Fact rows of the years before the batch in :attr:`sales_raw` arrived."""
        return self.sales(before=HISTORY_END)

    @cached_property
    def customers_raw(self) -> DataFrame:
        """Customer extract: everybody, with a new e-mail address."""
        return self.customers.select(*S.CUSTOMER_EXTRACT.fieldNames()).withColumn(
            "Email", F.concat(F.lit("new."), "Email")
        )

    @cached_property
    def known_customers(self) -> DataFrame:
        """Customer dimension before the at-risk segment was acquired."""
        return self.scored_customers.filter(F.col("Segment") != "At-Risk")

    @cached_property
    def stock(self) -> DataFrame:
        """Stock per product and store that ever met in an order line."""
        pairs = self.table("lineitem").select("l_partkey", "l_suppkey").distinct()
        return pairs.selectExpr(
            "CAST(l_partkey AS STRING) AS ProductID",
            "CAST(l_suppkey AS STRING) AS StoreID",
            "CAST((l_partkey * 7 + l_suppkey * 13) % 200 AS INT) AS QuantityOnHand",
            "CAST(l_partkey % 50 + 1 AS INT) AS ReorderPoint",
        )

    @cached_property
    def tickets(self) -> DataFrame:
        """Error events as support tickets, spread over the year before ``as_of``."""
        errors = self.table("events").filter("event_type = 'error'")
        created = F.date_sub(F.lit(self.as_of), F.expr("CAST(event_id % 365 AS INT)"))
        return errors.select(
            F.col("user_id").cast("string").alias("CustomerID"), created.cast("timestamp").alias("CreatedDate")
        )

    @cached_property
    def targets(self) -> DataFrame:
        """Monthly targets: order value of the same month one year before, plus growth."""
        cents = "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DECIMAL(22,0))"
        target = F.expr(f"CAST(round({cents} * {TARGET_GROWTH}BD * 0.01BD, 2) AS DECIMAL(20,2))")
        return (
            self.table("orders")
            .groupBy(F.month("o_orderdate").alias("Month"), (F.year("o_orderdate") + 1).alias("Year"))
            .agg(target.alias("MonthlyTarget"))
        )

    @cached_property
    def user_regions(self) -> DataFrame:
        """One manager per nation, responsible for its region."""
        return self.geography.selectExpr("concat(lower(State), '@stores.example') AS UserEmail", "Region")

    @cached_property
    def insights(self) -> DataFrame:
        """Assistant turns as stored narratives."""
        turns = self.table("conversations").filter("role = 'assistant'")
        areas = ", ".join(f"'{a}'" for a in INSIGHT_AREAS)
        return turns.select(
            F.date_sub(F.lit(self.as_of), F.expr("CAST(conv_id % 30 AS INT)")).alias("InsightDate"),
            F.expr(f"element_at(array({areas}), CAST(conv_id % 4 + 1 AS INT))").alias("InsightArea"),
            F.col("text").alias("InsightText"),
            F.lit(None).cast("string").alias("KPIContext"),
            F.lit("sample").alias("ModelVersion"),
            F.lit(None).cast("timestamp").alias("GeneratedAt"),
        )
