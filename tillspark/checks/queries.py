"""Every result of the engine as a query over a folder of sample tables.

Decimals leave a query as doubles, rounded half up, so that they can be
compared with another SQL engine.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tillspark import schemas as S
from tillspark.fixed_values import TREE_DEPTH
from tillspark.functions.dates import key_date, month_of_key
from tillspark.operators import checks
from tillspark.plans import (
    access,
    calendar,
    churn_model,
    customers,
    daily,
    forest,
    insights,
    inventory,
    measures,
    sales,
    sales_load,
    views,
)
from tillspark.session import work_dir
from tillspark.sources import extracts
from tillspark.sources.sample_tables import AS_OF, SampleTables
from tillspark.sources.warehouse import Warehouse
from tillspark.streaming.arrivals import load_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MANAGER = "nation_3@stores.example"
#: Landing files of whole jobs are compressed text, a quarter of the plain one.
LANDING_CODEC = "gzip"


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Round decimals (to 2 places) and doubles (to 6) unless ``digits`` says otherwise; decimals become doubles."""
    places = digits or {}

    def column(field):
        c = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return F.round(c, places.get(field.name, 2)).cast("double").alias(field.name)
        if isinstance(field.dataType, DoubleType):
            return F.round(c, places.get(field.name, 6)).alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema])


def _stored(spark: SparkSession, folder: str, name: str) -> Warehouse:
    """A warehouse of one query in the shared work folder."""
    source = hashlib.sha1(folder.encode()).hexdigest()[:8]
    return Warehouse(spark, f"{work_dir(spark)}/{name}-{source}")


# --- sales ------------------------------------------------------------------
def _summary(t: SampleTables) -> DataFrame:
    return sales.sales_summary(t.all_sales, t.dates, t.stores, t.products, t.customers)


def _daily_sales(t: SampleTables) -> DataFrame:
    """Net sales without returns per day and store; small, and additive for every report above it."""
    per_day = sales.kept_sales(t.all_sales).groupBy("DateKey", "StoreKey").agg(F.sum("NetSales").alias("NetSales"))
    return per_day.withColumn("FullDate", key_date(F.col("DateKey")))


@query
def sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_summary(SampleTables(spark, folder)))


@query
def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Over stored activity and inventory, as the day's run has them."""
    t = SampleTables(spark, folder)
    board = customers.churn_dashboard(t.scored_customers, _stored_activity(t))
    return comparable(sales.kpi_summary(_month_sales(t), t.scored_customers, board, _intelligence(t), t.as_of))


@query
def top_product_groups(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return comparable(sales.top_product_groups(_month_sales(t), t.products, t.as_of))


@query
def sales_measures(spark: SparkSession, folder: str) -> DataFrame:
    by_region = measures.sales_measures(_summary(SampleTables(spark, folder)), ["Region", "CustomerSegment"])
    return comparable(by_region, {"GrossMarginShare": 6})


@query
def sales_totals(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(measures.sales_measures(_summary(SampleTables(spark, folder))), {"GrossMarginShare": 6})


@query
def sales_report(spark: SparkSession, folder: str) -> DataFrame:
    """Regions and segments with subtotals per region, per store type, and the grand total, from one scan."""
    contexts = [*measures.levels(["Region", "CustomerSegment"]), ["StoreType"]]
    return comparable(measures.sales_report(_summary(SampleTables(spark, folder)), contexts), {"GrossMarginShare": 6})


@query
def avg_order_value(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    kept = sales.kept_sales(t.all_sales).withColumn("SaleMonth", month_of_key(F.col("DateKey")))
    return comparable(measures.avg_order_value(kept, ["SaleMonth"]))


@query
def sales_yoy(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    by_store = _daily_sales(t).join(t.stores.select("StoreKey", "Region"), "StoreKey")
    return comparable(measures.sales_yoy(by_store, ["Region"]), {"YoYChange": 6})


@query
def sales_ytd(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(measures.sales_ytd(_daily_sales(SampleTables(spark, folder))))


@query
def target_attainment(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    month = sales.kept_sales(sales.current_month(_month_sales(t), t.as_of))
    return comparable(measures.target_attainment(month, t.targets, t.as_of), {"TargetAttainment": 6})


@query
def region_security(spark: SparkSession, folder: str) -> DataFrame:
    """Regional sales as three principals see them; sales are summed per store once for all."""
    t = SampleTables(spark, folder)

    def seen_by(principal: str, role: str) -> DataFrame:
        stores = access.visible_to(t.stores, t.user_regions, principal, role)
        return stores.select("StoreKey", "Region", "State", F.lit(principal).alias("Principal"))

    seen = seen_by(MANAGER, "RegionManagers").unionByName(seen_by("nobody@stores.example", "StoreManagers"))
    seen = seen.unionByName(seen_by("chief@stores.example", "Executives"))
    totals = _daily_sales(t).groupBy("StoreKey").agg(F.sum("NetSales").alias("NetSales"))
    by_state = totals.join(seen, "StoreKey").groupBy("Principal", "Region", "State")
    return comparable(by_state.agg(F.sum("NetSales").alias("NetSales")))


def _report_warehouse(t: SampleTables) -> Warehouse:
    """A warehouse with all that the four reports read; filled by the first query of a session."""
    warehouse = _stored(t.spark, t.folder, "reports")
    if warehouse.read("UserRegions").isEmpty():
        _fill_dimensions(t, warehouse)
        warehouse.replace("DimCustomer", t.scored_customers)
        warehouse.replace("FactCustomerActivity", _stored_activity(t))
        warehouse.put_batch("FactSales", t.all_sales.drop(*sales_load.MEASURES), "all", sales_load.with_measures)
        # Stored by day already, so a task reads files of one day or a few.
        warehouse.put_snapshot("FactInventory", _inventory(t).select(*S.FACT_INVENTORY.fieldNames()), by_day=True)
        warehouse.replace("UserRegions", t.user_regions)
    return warehouse


@query
def restricted_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The four registered report views as a manager of one region reads them."""
    t = SampleTables(spark, folder)
    views.register(_report_warehouse(t), t.as_of, MANAGER)

    def per_region(view: str, amount: str) -> DataFrame:
        rows = spark.table(view).groupBy("Region").agg(F.count(F.lit(1)).alias("ReportRows"), F.sum(amount).alias("Amount"))
        return rows.select(F.lit(view).alias("Report"), "Region", "ReportRows", F.round("Amount", 2).cast("double").alias("Amount"))

    kpis = spark.table("vw_KPISummary").select(
        F.lit("vw_KPISummary").alias("Report"), F.lit(None).cast("string").alias("Region"), F.col("TotalOrders").alias("ReportRows"),
        F.round("TotalRevenue", 2).cast("double").alias("Amount"),
    )
    parts = {"vw_SalesSummary": "NetSales", "vw_ChurnRiskDashboard": "RevenueAtRisk", "vw_InventoryIntelligence": "InventoryValue"}
    return reduce(DataFrame.unionByName, [kpis, *(per_region(view, amount) for view, amount in parts.items())])


# --- sales load -------------------------------------------------------------
def _load_inputs(t: SampleTables) -> tuple[DataFrame, ...]:
    return t.sales_raw, t.customers, t.products, t.stores, t.loaded_history


@query
def fact_sales_load(spark: SparkSession, folder: str) -> DataFrame:
    facts = sales_load.new_facts(*_load_inputs(SampleTables(spark, folder)))
    return comparable(facts, {"NetSales": 6, "GrossProfit": 6})


@query
def sales_rejects(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return sales_load.rejects(t.sales_raw, t.as_of).withColumn("RejectDate", F.col("RejectDate").cast("date"))


@query
def sales_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return sales_load.outcome_counts(sales_load.outcomes(*_load_inputs(SampleTables(spark, folder))))


@query
def sales_silent_drops(spark: SparkSession, folder: str) -> DataFrame:
    return sales_load.silent_drops(sales_load.outcomes(*_load_inputs(SampleTables(spark, folder))))


@query
def processed_marks(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    day = F.col("ProcessedDate").cast("date").alias("ProcessedDate")
    marked = sales_load.marked_processed(t.sales_raw, t.as_of)
    return marked.groupBy("ProcessedFlag", day).agg(F.count(F.lit(1)).alias("SalesLines"))


@query
def orphan_check(spark: SparkSession, folder: str) -> DataFrame:
    """All sales against the master data of active customers and a calendar that ends with the history."""
    t = SampleTables(spark, folder)
    dims = {
        "DimCustomer": t.customers.filter("IsActive"),
        "DimDate": calendar.calendar_between(spark, "1996-01-01", "2000-12-31"),
        "DimProduct": t.products,
        "DimStore": t.stores.filter(F.col("StoreType") != "Outlet"),
    }
    facts = {
        "FactSales": (t.all_sales, S.SALES_FOREIGN_KEYS),
        "FactInventory": (_inventory(t), S.INVENTORY_FOREIGN_KEYS),
        "FactCustomerActivity": (_stored_activity(t), S.ACTIVITY_FOREIGN_KEYS),
    }
    parts = [checks.orphans(fact, dims, keys).withColumn("FactTable", F.lit(name)) for name, (fact, keys) in facts.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def product_margins(spark: SparkSession, folder: str) -> DataFrame:
    """Margins that the warehouse computed when the products were written."""
    t = SampleTables(spark, folder)
    written = _stored(spark, folder, "products").replace("DimProduct", t.products.drop("GrossMarginPct").withColumn("GrossMarginPct", F.lit(None)))
    return comparable(written.select("ProductID", "GrossMarginPct"))


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    tables = {"DimCustomer": t.customers, "DimProduct": t.products, "DimStore": t.stores, "FactSales": t.all_sales}
    return checks.duplicate_keys(tables, {**S.BUSINESS_KEYS, "FactSales": sales_load.LINE_KEY})


@query
def null_check(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    tables = {
        "DimCustomer": t.customers,
        "DimProduct": t.products,
        "DimStore": t.stores,
        "FactSales": t.all_sales,
        "DimDate": t.dates,
        "FactInventory": _inventory(t),
        "FactCustomerActivity": _stored_activity(t),
        "AIInsights": t.insights,
        "SalesRaw": t.sales_raw,
    }
    required = {**S.REQUIRED_COLUMNS, "SalesRaw": ["OrderID", "Quantity", "UnitPrice", "Discount", "ReturnFlag"]}
    return checks.missing_values(tables, required)


@query
def calendar_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar of all years with orders; the first of January is a holiday."""
    placed = SampleTables(spark, folder).table("orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    day = F.col("FullDate")
    return calendar.calendar(
        placed,
        F.trunc(F.col("first").cast("date"), "year"),
        F.last_day(F.add_months(F.trunc(F.col("last").cast("date"), "year"), 11)),
        (F.month(day) == 1) & (F.dayofmonth(day) == 1),
    )


# --- customers --------------------------------------------------------------
def _activity(t: SampleTables) -> DataFrame:
    return customers.customer_activity(t.customers, t.all_sales, t.dates, t.products, t.tickets, t.as_of)


def _dashboard(t: SampleTables) -> DataFrame:
    return customers.churn_dashboard(t.scored_customers, _activity(t))


@query
def customer_activity(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_activity(SampleTables(spark, folder)))


@query
def churn_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    digits = {"ChurnRiskScore": 4, "RevenueAtRisk": 4}
    return comparable(_dashboard(SampleTables(spark, folder)), digits)


@query
def churn_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(customers.churn_by_region(_dashboard(SampleTables(spark, folder))))


@query
def apply_churn_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of customers with orders applied to all customers, with the recommended action."""
    t = SampleTables(spark, folder)
    buyers = t.table("orders").select(F.col("o_custkey").cast("string").alias("CustomerID")).distinct()
    scored = customers.apply_churn_scores(t.customers, t.churn_scores.join(buyers, "CustomerID", "left_semi"), t.as_of)
    actions = customers.recommended_actions(scored)
    return comparable(actions.join(scored.select("CustomerID", "LastScoredDate"), "CustomerID"), {"ChurnRiskScore": 4})


@query
def customer_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate keys of new customers are arbitrary; only those of known customers are shown."""
    t = SampleTables(spark, folder)
    merged = customers.upsert_customers(t.known_customers, t.customers_raw)
    highest = t.known_customers.agg(F.max("CustomerKey")).scalar()
    known_key = F.when(F.col("CustomerKey") <= highest, F.col("CustomerKey")).alias("KnownKey")
    shown = merged.select(
        "CustomerID", "Email", "Segment", "Region", "JoinDate", "IsActive", "ChurnRiskScore", "ChurnRiskCategory", known_key
    )
    return comparable(shown, {"ChurnRiskScore": 4})


@query
def churn_measures(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(
        measures.churn_measures(_dashboard(SampleTables(spark, folder)), ["Segment"]),
        {"AvgChurnRiskScore": 6, "RetentionUplift": 4},
    )


@query
def churn_category_share(spark: SparkSession, folder: str) -> DataFrame:
    """Categories in one region next to the company-wide count."""
    board = _dashboard(SampleTables(spark, folder)).select("Region", "Segment", "ChurnRiskCategory")
    return measures.churn_category_share(board, board.filter(F.col("Region") == "ASIA"), ["Segment"])


# --- inventory --------------------------------------------------------------
def _window_sales(t: SampleTables) -> DataFrame:
    """Sales from 37 days before ``as_of``: enough for both snapshots."""
    return t.sales(since=t.as_of - dt.timedelta(days=37))


def _month_sales(t: SampleTables) -> DataFrame:
    return t.sales(since=t.as_of.replace(day=1))


def _inventory(t: SampleTables) -> DataFrame:
    """Two stored days: a week ago and today."""
    recent = _window_sales(t)
    earlier, today = (
        inventory.inventory_snapshot(t.stock, t.products, t.stores, recent, day)
        for day in (t.as_of - dt.timedelta(days=7), t.as_of)
    )
    warehouse = _stored(t.spark, t.folder, "inventory")
    if warehouse.read("FactInventory").isEmpty():
        warehouse.put_snapshot("FactInventory", earlier.unionByName(today), by_day=True)
    return warehouse.read("FactInventory")


def _intelligence(t: SampleTables) -> DataFrame:
    return inventory.inventory_intelligence(_inventory(t), t.products, t.stores, t.dates)


@query
def avg_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return comparable(inventory.avg_daily_sales(_window_sales(t), t.as_of))


@query
def inventory_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return inventory.inventory_snapshot(t.stock, t.products, t.stores, _window_sales(t), t.as_of)


@query
def inventory_intelligence(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_intelligence(SampleTables(spark, folder)))


@query
def inventory_report(spark: SparkSession, folder: str) -> DataFrame:
    """Stock figures per region and category, per region, and in all."""
    return comparable(measures.inventory_report(_intelligence(SampleTables(spark, folder)), measures.levels(["Region", "Category"])))


@query
def inventory_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.inventory_alerts(_intelligence(SampleTables(spark, folder)))


@query
def inventory_measures(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(measures.inventory_measures(_intelligence(SampleTables(spark, folder)), ["Region"]))


@query
def stored_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots written day by day, the last one twice: a repeated day replaces itself."""
    t = SampleTables(spark, folder)
    warehouse = _stored(spark, folder, "snapshots")
    # Three snapshots read both: they are computed once.
    stock, recent = warehouse.staged("Stock", t.stock), warehouse.staged("RecentSales", _window_sales(t))
    for day in (t.as_of - dt.timedelta(days=7), t.as_of, t.as_of):
        warehouse.put_snapshot(
            "FactInventory", inventory.inventory_snapshot(stock, t.products, t.stores, recent, day), by_day=True
        )
    return (
        warehouse.read("FactInventory")
        .groupBy("DateKey", "StockOutRisk", "OverstockFlag")
        .agg(F.count(F.lit(1)).alias("StockLines"), F.sum("QuantityOnHand").alias("UnitsOnHand"))
    )


# --- insights ---------------------------------------------------------------
@query
def latest_insights(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return insights.latest_insights(t.insights, insights.area_list(spark))


@query
def insights_last_updated(spark: SparkSession, folder: str) -> DataFrame:
    return insights.insights_last_updated(SampleTables(spark, folder).insights)


def _context(t: SampleTables) -> DataFrame:
    """Stored context over stored activity and inventory, which several of its parts read."""
    board = customers.churn_dashboard(t.scored_customers, _stored_activity(t))
    stock, month = _intelligence(t), _month_sales(t)
    context = insights.kpi_context(
        sales.kpi_summary(month, t.scored_customers, board, stock, t.as_of),
        sales.top_product_groups(month, t.products, t.as_of),
        customers.churn_by_region(board),
        inventory.inventory_alerts(stock),
    )
    return _stored(t.spark, t.folder, "context").replace("KPIContext", context)


CONTEXT_SCHEMA = (
    "summary struct<Period: string, TotalRevenue: decimal(28,6), TotalGrossProfit: decimal(28,6),"
    " GrossMarginPct: double, TotalOrders: long, ActiveCustomers: long, AvgRevenuePerCustomer: double,"
    " HighChurnCustomers: long, TotalRevenueAtRisk: decimal(28,4), HighStockOutSKUs: long>,"
    " top_products array<struct<category: string, sub_category: string, net_sales: double,"
    " gross_profit: double, units_sold: long>>,"
    " churn_by_region array<struct<region: string, customers: long, revenue_at_risk: double>>,"
    " inventory_alerts array<struct<product: string, category: string, store_type: string,"
    " qty_on_hand: long, days_of_supply: long, risk: string>>"
)


@query
def kpi_context(spark: SparkSession, folder: str) -> DataFrame:
    """The document read back from its JSON text, one row per list item."""
    document = _context(SampleTables(spark, folder)).select(F.from_json("KPIContext", CONTEXT_SCHEMA).alias("d"))

    def items(section: str, label: str, value: str, amount: str) -> DataFrame:
        rows = document.select(F.posexplode(f"d.{section}").alias("Position", "item"))
        return rows.select(
            F.lit(section).alias("Section"),
            "Position",
            F.expr(label).alias("Label"),
            F.col(value).cast("long").alias("Quantity"),
            F.round(F.col(amount).cast("double"), 2).alias("Amount"),
        )

    summary = document.select(
        F.lit("summary").alias("Section"),
        F.lit(0).alias("Position"),
        F.col("d.summary.Period").alias("Label"),
        F.col("d.summary.TotalOrders").alias("Quantity"),
        F.round("d.summary.TotalRevenue", 2).cast("double").alias("Amount"),
    )
    counts = ["ActiveCustomers", "HighChurnCustomers", "HighStockOutSKUs"]
    amounts = ["TotalGrossProfit", "GrossMarginPct", "AvgRevenuePerCustomer", "TotalRevenueAtRisk"]
    fields = [
        F.struct(
            F.lit(i).alias("Position"), F.lit(name).alias("Label"),
            (F.col(f"d.summary.{name}") if name in counts else F.lit(None)).cast("long").alias("Quantity"),
            (F.lit(None) if name in counts else F.round(F.col(f"d.summary.{name}").cast("decimal(28,6)"), 2)).cast("double").alias("Amount"),
        )
        for i, name in enumerate([*counts, *amounts], 1)
    ]
    others = document.select(F.explode(F.array(*fields)).alias("f")).select(F.lit("summary").alias("Section"), "f.*")
    profits = items("top_products", "concat(item.category, '/', item.sub_category)", "item.units_sold", "item.gross_profit")
    return (
        summary.unionByName(others).unionByName(profits.withColumn("Section", F.lit("top_products_profit"))).unionByName(
            items("top_products", "concat(item.category, '/', item.sub_category)", "item.units_sold", "item.net_sales")
        )
        .unionByName(items("churn_by_region", "item.region", "item.customers", "item.revenue_at_risk"))
        .unionByName(
            items(
                "inventory_alerts",
                "concat(item.product, '/', item.category, '/', item.store_type, '/', item.risk)",
                "item.qty_on_hand",
                "item.days_of_supply",
            )
        )
    )


@query
def insight_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts taken apart: the wording around the figures, and figures read back from the prompt."""
    t = SampleTables(spark, folder)
    context = _context(t)
    prompts = insights.insight_prompts(insights.area_list(spark), context, t.as_of)
    figures = context.select("KPIText").scalar()
    wording = F.replace("Prompt", figures, F.lit("{}"))
    quoted = F.when(F.contains("Prompt", figures), F.from_json(figures, CONTEXT_SCHEMA)).alias("d")
    return prompts.select("InsightArea", wording.alias("Wording"), quoted).select(
        "InsightArea",
        "Wording",
        F.col("d.summary.TotalOrders").alias("TotalOrders"),
        F.round("d.summary.TotalRevenue", 2).cast("double").alias("TotalRevenue"),
        F.size("d.top_products").alias("TopProducts"),
    )


@query
def saved_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Insights stored in two batches, one of them written twice."""
    t = SampleTables(spark, folder)
    warehouse = _stored(spark, folder, "insights")
    newest = F.col("InsightDate") == F.lit(t.as_of)
    for batch, part in (("older", t.insights.filter(~newest)), ("newest", t.insights.filter(newest))):
        insights.save_insights(warehouse, part, batch)
    insights.save_insights(warehouse, t.insights.filter(newest), "newest")
    return warehouse.read("AIInsights").select("InsightDate", "InsightArea", "InsightText", "ModelVersion")


# --- churn model ------------------------------------------------------------
def _stored_activity(t: SampleTables) -> DataFrame:
    """Activity as the day has stored it; the first query of a session that needs it is the day."""
    warehouse = _stored(t.spark, t.folder, "activity")
    stored = warehouse.read("FactCustomerActivity")
    return warehouse.replace("FactCustomerActivity", _activity(t)) if stored.isEmpty() else stored


def _features(t: SampleTables) -> DataFrame:
    return churn_model.load_features(t.customers, _stored_activity(t), t.as_of)


def prepared_features(t: SampleTables) -> DataFrame:
    return churn_model.prepare_features(_features(t))


def _model(t: SampleTables, prepared: DataFrame) -> PipelineModel:
    return churn_model.train_or_load(prepared, _stored(t.spark, t.folder, "model").root)


@query
def churn_features(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(prepared_features(SampleTables(spark, folder)))


@query
def feature_profile(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(churn_model.score_profile(SampleTables(spark, folder).churn_scores))


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    features = _features(SampleTables(spark, folder)).select("CustomerID", "ChurnLabel")
    train, test = churn_model.split_by_label(features)
    parts = train.withColumn("Part", F.lit("train")).unionByName(test.withColumn("Part", F.lit("test")))
    return parts.groupBy("Part", "ChurnLabel").agg(
        F.count(F.lit(1)).alias("Customers"), F.count_distinct("CustomerID").alias("DistinctCustomers")
    )


def _table_scores(t: SampleTables) -> DataFrame:
    """Scores from the tables of the forest."""
    prepared = prepared_features(t)
    _model(t, prepared)
    nodes, inputs = forest.load_tables(t.spark, _stored(t.spark, t.folder, "model").root)
    return forest.score(prepared, nodes, inputs, TREE_DEPTH, t.as_of)


@query
def churn_scores(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_table_scores(SampleTables(spark, folder)), {"ChurnProbability": 4})


@query
def forest_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Customers scored by the model and from its tables, and how many of them got the same score, to four places."""
    t = SampleTables(spark, folder)
    prepared = prepared_features(t)
    by_model = churn_model.score(_model(t, prepared), prepared, t.as_of)
    both = by_model.join(_table_scores(t).select("CustomerID", F.col("ChurnProbability").alias("__again")), "CustomerID", "full")
    same = F.count(F.when(F.col("ChurnProbability") == F.col("__again"), 1))
    return both.agg(F.count(F.lit(1)).alias("Customers"), same.alias("SameScores"))


@query
def score_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """The sample's stored scores as a prediction of the label: rank-sum AUC and the figures of each class."""
    t = SampleTables(spark, folder)
    labels = _features(t).select("CustomerID", "ChurnLabel")
    p = F.col("ChurnProbability")
    predicted = labels.join(t.churn_scores, "CustomerID").select("ChurnLabel", (p > 0.5).cast("int").alias("Predicted"), p.cast("double").alias("Score"))
    return comparable(churn_model.evaluation(predicted))


@query
def churn_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    prepared = prepared_features(t)
    return churn_model.evaluate(_model(t, prepared), churn_model.split_by_label(prepared)[1])


@query
def churn_importance(spark: SparkSession, folder: str) -> DataFrame:
    t = SampleTables(spark, folder)
    return churn_model.feature_importance(_model(t, prepared_features(t)), spark)


@query
def score_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The preview file, read back."""
    t = SampleTables(spark, folder)
    preview = churn_model.score_preview(_table_scores(t))
    path = f"{_stored(spark, folder, 'preview').root}/scores"
    extracts.write_extract(preview, path)
    schema = "CustomerID string, ChurnProbability decimal(5,4), ChurnRiskCategory string, ScoredDate date"
    return comparable(spark.read.schema(schema).option("header", True).csv(path), {"ChurnProbability": 4})


# --- whole jobs -------------------------------------------------------------
def _as_extract(raw: DataFrame) -> DataFrame:
    """Staging rows as a landing file has them."""
    flag = F.col("ReturnFlag").cast("int").alias("ReturnFlag")
    return raw.select(*[flag if c == "ReturnFlag" else F.col(c) for c in S.SALES_EXTRACT.fieldNames()])


def _fill_dimensions(t: SampleTables, warehouse: Warehouse) -> None:
    warehouse.replace("DimDate", t.dates)
    warehouse.replace("DimStore", t.stores)
    warehouse.replace("DimProduct", t.products)


@query
def incremental_sales_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries; the second one repeats the first, whose lines must not load again."""
    t = SampleTables(spark, folder)
    warehouse = _stored(spark, folder, "arrivals")
    _fill_dimensions(t, warehouse)
    warehouse.replace("DimCustomer", t.customers)
    landing, checkpoint = f"{warehouse.root}/landing", f"{warehouse.root}/checkpoint"
    first = t.sales_raw.filter(F.col("OrderDate") < F.lit(dt.date(1998, 1, 1)))
    for name, part in (("sales_1.csv", first), ("sales_2.csv", t.sales_raw)):
        extracts.write_extract(_as_extract(part), f"{landing}/{name}", LANDING_CODEC)
        load_arrivals(warehouse, landing, checkpoint, t.as_of, "arrivals")
    loaded = warehouse.read("FactSales").select(*S.FACT_SALES.fieldNames())
    return comparable(loaded, {"NetSales": 6, "GrossProfit": 6})


@query
def daily_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A whole day from landing files to stored insights."""
    t = SampleTables(spark, folder)
    warehouse = _stored(spark, folder, "daily")
    landing = f"{warehouse.root}/landing"
    _fill_dimensions(t, warehouse)
    warehouse.replace("DimCustomer", t.known_customers)
    warehouse.replace("SupportTickets", t.tickets)
    extracts.write_extract(_as_extract(t.sales_raw), f"{landing}/sales_today.csv", LANDING_CODEC)
    extracts.write_extract(t.customers_raw, f"{landing}/customers.csv", LANDING_CODEC)
    extracts.write_extract(t.stock, f"{landing}/inventory.csv", LANDING_CODEC)
    report = daily.run_day(
        warehouse,
        landing,
        t.as_of,
        batch_id=AS_OF.isoformat(),
        model_path=f"{warehouse.root}/model",
        write_texts=lambda prompts: prompts.select("InsightArea", F.col("Prompt").alias("InsightText")),
        model_version="sample",
    )

    def amount(name: str, column: str) -> DataFrame:
        return warehouse.read(name).agg(F.round(F.sum(column), 2).cast("double").alias("Amount")).select(F.lit(name).alias("TableName"), "Amount")

    parts = {"SalesRaw": "Quantity", "InventoryRaw": "ReorderPoint", "FactSales": "NetSales", "FactInventory": "QuantityOnHand"}
    amounts = reduce(DataFrame.unionByName, [amount(name, column) for name, column in parts.items()])
    return report.join(F.broadcast(amounts), "TableName", "left")  # one row per table
