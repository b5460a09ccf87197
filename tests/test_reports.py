"""Calendar, inventory, measures, security and insights."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF, DATES
from tillspark import fixed_values as V
from tillspark import schemas as S
from tillspark.plans import access, calendar, customers, insights, inventory, measures, sales
from tillspark.plans.sales import kept_sales


def day(text):
    return dt.date.fromisoformat(text)


# --- calendar ---------------------------------------------------------------
def test_calendar_reproduces_the_golden_days(spark):
    new_year = (F.month("FullDate") == 1) & (F.dayofmonth("FullDate") == 1)
    made = calendar.calendar_between(spark, "2026-01-01", "2026-03-03", new_year)
    assert made.count() == 62
    rows = {r.DateKey: tuple(r) for r in made.collect()}
    for expected in DATES:
        assert rows[expected[0]] == (expected[0], day(expected[1]), *expected[2:])


def test_saturdays_are_weekend(spark):
    assert calendar.calendar_between(spark, "2026-03-07", "2026-03-07").first().IsWeekend


# --- customers --------------------------------------------------------------
def test_activity_of_a_customer_without_sales(spark, golden):
    fact = golden.fact.filter("CustomerKey <> 2")
    tickets = spark.createDataFrame(
        [("CUST002", dt.datetime(2025, 9, 3)), ("CUST002", dt.datetime(2025, 9, 2)), (None, dt.datetime(2026, 1, 1))],
        S.SUPPORT_TICKETS,
    )
    activity = customers.customer_activity(
        golden.customers, fact, golden.dates, golden.products, tickets, AS_OF
    )
    row = activity.filter("CustomerKey = 2").first()
    assert (row.TotalOrders, row.UniqueCategories, row.SupportTickets) == (0, 0, 1)
    assert (row.TotalSpend, row.AvgOrderValue, row.DaysSinceLastPurchase) == (None, None, None)


def test_inactive_customers_have_no_activity_and_no_dashboard_row(golden):
    some = golden.customers.withColumn("IsActive", F.col("CustomerKey") != 3)
    activity = customers.customer_activity(some, golden.fact, golden.dates, golden.products, golden.tickets, AS_OF)
    assert activity.count() == 7
    assert customers.churn_dashboard(some, activity).filter("CustomerID = 'CUST003'").count() == 0


def test_returns_count_in_activity_but_not_in_the_summary(golden):
    fact = golden.fact.withColumn("ReturnFlag", F.lit(True))
    activity = customers.customer_activity(
        golden.customers, fact, golden.dates, golden.products, golden.tickets, AS_OF
    )
    assert activity.agg(F.sum("TotalOrders")).first()[0] == 10
    assert sales.sales_summary(fact, golden.dates, golden.stores, golden.products, golden.customers).count() == 0


def test_summary_counts_orders_and_customers_from_one_shuffle(spark):
    rows = [(1, "A", 1), (1, "A", 2), (1, "A", 2), (1, None, 2), (1, None, 3), (2, "A", 1), (2, "B", 1), (3, None, 4), (3, "C", None)]
    lines = spark.createDataFrame(rows, "k int, OrderID string, CustomerKey long").selectExpr(
        "*", "1 AS Quantity", *[f"CAST(k AS DECIMAL(18,6)) AS {c}" for c in ("GrossSales", "NetSales", "GrossProfit")]
    )
    groups = sales._group_totals(lines, ["k"])
    got = sorted(groups.select("k", "UnitsSold", "OrderCount", "UniqueCustomers", F.col("NetSales").cast("int")).collect())
    assert list(map(tuple, got)) == [(1, 5, 1, 3, 5), (2, 2, 2, 1, 4), (3, 2, 1, 1, 6)]
    assert groups.schema["NetSales"].dataType.simpleString() == "decimal(28,6)"


def test_summary_does_not_copy_sales(golden):
    summary = sales.sales_summary(golden.fact, golden.dates, golden.stores, golden.products, golden.customers)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_dashboard_name_is_null_without_a_last_name(golden):
    unnamed = golden.customers.withColumn("LastName", F.lit(None).cast("string"))
    activity = golden.spark.createDataFrame([], S.FACT_CUSTOMER_ACTIVITY)
    rows = customers.churn_dashboard(unnamed, activity).collect()
    assert len(rows) == 8
    assert {r.CustomerName for r in rows} == {None}


def test_apply_scores_covers_inactive_and_spares_unmatched(spark, golden):
    some = golden.customers.withColumn("IsActive", F.col("CustomerKey") != 1)
    scores = spark.createDataFrame(
        [("CUST001", Decimal("0.7000"), AS_OF), ("CUST002", None, AS_OF), ("CUST999", Decimal("0.9000"), AS_OF)],
        S.CHURN_SCORES,
    )
    rows = {r.CustomerID: r for r in customers.apply_churn_scores(some, scores, AS_OF).collect()}
    assert (rows["CUST001"].ChurnRiskScore, rows["CUST001"].ChurnRiskCategory) == (Decimal("0.7000"), "High")
    assert (rows["CUST002"].ChurnRiskScore, rows["CUST002"].ChurnRiskCategory) == (None, "Low")
    assert rows["CUST002"].LastScoredDate == AS_OF
    assert (rows["CUST003"].ChurnRiskCategory, rows["CUST003"].LastScoredDate) == ("High", None)
    assert len(rows) == 8


# --- inventory --------------------------------------------------------------
@pytest.fixture(scope="module")
def stock(spark):
    rows = [
        ("PRD004", "STR003", 0, 10),
        ("PRD002", "STR001", 10, 10),
        ("PRD001", "STR001", 31, 10),
        ("PRD003", "STR001", 7, 1),
        ("PRD999", "STR001", 5, 5),
    ]
    return spark.createDataFrame(rows, S.INVENTORY_EXTRACT)


def test_snapshot(golden, stock):
    rows = inventory.inventory_snapshot(stock, golden.products, golden.stores, golden.fact, AS_OF).collect()
    found = {r.ProductKey: (r.DaysOfSupply, r.StockOutRisk, r.OverstockFlag) for r in rows}
    # product 2 sold 2 pieces and product 3 two pieces on the thirtieth day before
    assert found == {
        4: (0, "High", False),
        2: (150, "Medium", False),
        1: (999, "Low", True),
        3: (105, "Low", True),
    }
    assert {r.DateKey for r in rows} == {20260303}


def test_sales_window_includes_the_thirtieth_day_only(golden):
    rates = inventory.avg_daily_sales(golden.fact, dt.date(2026, 3, 3)).collect()
    assert {(r.ProductKey, r.StoreKey) for r in rates} == {(7, 4), (3, 1), (6, 3), (1, 5), (8, 2), (4, 3), (2, 1)}
    later = inventory.avg_daily_sales(golden.fact, dt.date(2026, 3, 4)).collect()
    assert {(r.ProductKey, r.StoreKey) for r in later} == {(6, 3), (1, 5), (8, 2), (4, 3), (2, 1)}


def test_intelligence_shows_the_latest_snapshot(golden, stock):
    snap = [
        inventory.inventory_snapshot(stock, golden.products, golden.stores, golden.fact, d)
        for d in (dt.date(2026, 3, 1), AS_OF)
    ]
    report = inventory.inventory_intelligence(snap[0].union(snap[1]), golden.products, golden.stores, golden.dates)
    rows = {r.ProductID: r for r in report.collect()}
    assert {r.SnapshotDate for r in rows.values()} == {AS_OF}
    assert len(rows) == 4
    assert (rows["PRD001"].InventoryValue, rows["PRD001"].OverstockCost) == (Decimal("1395"), Decimal("495"))
    assert rows["PRD002"].OverstockCost == 0
    alerts = inventory.inventory_alerts(report).collect()
    assert [(a.ProductID, a.StockOutRisk) for a in alerts] == [("PRD004", "High"), ("PRD002", "Medium")]

    row = measures.inventory_measures(report).first()
    assert row.TotalInventoryValue == Decimal("1395") + Decimal("280") + Decimal("224")
    assert (row.HighStockOutSKUs, row.AvgDaysOfSupply, row.OverstockRate) == (1, 85.0, 0.5)


# --- measures ---------------------------------------------------------------
@pytest.fixture(scope="module")
def summary(golden):
    return sales.sales_summary(golden.fact, golden.dates, golden.stores, golden.products, golden.customers)


@pytest.fixture(scope="module")
def daily(golden):
    return kept_sales(golden.fact).join(golden.dates, "DateKey").select("FullDate", "NetSales")


def test_sales_measures(golden, summary):
    row = measures.sales_measures(summary).first()
    assert row.TotalNetSales == Decimal("1631.3365")
    assert row.AvgOrderValue == Decimal("1631.3365")
    true_value = measures.avg_order_value(golden.fact).first()
    assert (true_value.Orders, true_value.AvgOrderValueTrue) == (10, Decimal("163.13365"))
    by_segment = measures.sales_measures(summary, ["CustomerSegment"]).collect()
    assert sum(r.TotalNetSales for r in by_segment) == Decimal("1631.3365")


def test_year_over_year_survives_gaps(spark):
    rows = [("2020-03-01", 100), ("2021-03-05", 150), ("2023-03-01", 300), ("2021-04-01", 7), ("2022-04-01", 0),
            ("2023-04-01", 5)]
    df = spark.createDataFrame([(day(d), Decimal(v)) for d, v in rows], "FullDate date, NetSales decimal(18,6)")
    found = {(r.Year, r.MonthNumber): float(r.YoYChange) for r in measures.sales_yoy(df).collect()}
    assert found == {(2020, 3): 0, (2021, 3): 0.5, (2023, 3): 0, (2021, 4): 0, (2022, 4): -1, (2023, 4): 0}


def test_year_to_date_starts_over(daily, spark):
    rows = [("2020-12-31", 5), ("2021-01-01", 1), ("2021-01-01", 2), ("2021-06-01", 3)]
    df = spark.createDataFrame([(day(d), Decimal(v)) for d, v in rows], "FullDate date, NetSales decimal(18,6)")
    found = {str(r.FullDate): r.YTDNetSales for r in measures.sales_ytd(df).collect()}
    assert found == {"2020-12-31": 5, "2021-01-01": 3, "2021-06-01": 6}
    last = measures.sales_ytd(daily).orderBy(F.desc("FullDate")).first()
    assert last.YTDNetSales == Decimal("1631.3365")


def test_target_attainment(spark, golden):
    targets = spark.createDataFrame(
        [(3, 2026, Decimal("500.00")), (3, 2026, Decimal("323.90")), (3, 2025, Decimal("9.00"))], S.TARGETS
    )
    march = sales.current_month(golden.fact, AS_OF)
    row = measures.target_attainment(march, targets, AS_OF).first()
    assert (row.RevenueTarget, round(row.TargetAttainment, 4)) == (Decimal("823.90"), Decimal("0.5000"))
    none = measures.target_attainment(march, targets.filter("Year = 2025"), AS_OF).first()
    assert (none.RevenueTarget, none.TargetAttainment) == (None, 0)


def test_churn_measures(golden):
    activity = customers.customer_activity(
        golden.customers, golden.fact, golden.dates, golden.products, golden.tickets, AS_OF
    )
    board = customers.churn_dashboard(golden.customers, activity)
    row = measures.churn_measures(board).first()
    assert row.HighRiskCustomers == 3
    assert row.TotalRevenueAtRisk == Decimal("5189.8740")
    assert row.RetentionUplift == Decimal("518.9874")
    assert (row.AvgChurnRiskScore, row.AvgDaysSincePurchase) == (Decimal("0.41500000"), 19.75)
    shown = board.filter("Region = 'South'")
    rows = {r.ChurnRiskCategory: (r.Customers, r.CategoryCustomers)
            for r in measures.churn_category_share(board, shown).collect()}
    assert rows == {"Low": (3, 3), "Medium": (1, 2), "High": (2, 3)}


# --- security ---------------------------------------------------------------
def test_region_security(spark, golden):
    users = spark.createDataFrame(
        [("south@x.example", "South"), ("south@x.example", "National"), ("ny@x.example", "Northeast")], S.USER_REGIONS
    )

    def seen(principal, role):
        return access.visible_to(golden.stores, users, principal, role).count()

    assert seen("south@x.example", "RegionManagers") == 4
    assert seen("ny@x.example", "StoreManagers") == 1
    assert seen("stranger@x.example", "RegionManagers") == 0
    assert seen("stranger@x.example", "Executives") == 5


# --- insights ---------------------------------------------------------------
@pytest.fixture(scope="module")
def context(golden, stock):
    activity = customers.customer_activity(
        golden.customers, golden.fact, golden.dates, golden.products, golden.tickets, AS_OF
    )
    board = customers.churn_dashboard(golden.customers, activity)
    snap = inventory.inventory_snapshot(stock, golden.products, golden.stores, golden.fact, AS_OF)
    report = inventory.inventory_intelligence(snap, golden.products, golden.stores, golden.dates)
    return insights.kpi_context(
        sales.kpi_summary(golden.fact, golden.customers, board, report, AS_OF),
        sales.top_product_groups(golden.fact, golden.products, AS_OF),
        customers.churn_by_region(board),
        inventory.inventory_alerts(report),
    )


def test_kpi_context(context):
    row = context.first()
    document = json.loads(row.KPIContext)
    assert document == json.loads(row.KPIText)
    assert document["summary"]["TotalRevenue"] == 411.951
    assert document["summary"]["HighStockOutSKUs"] == 1
    assert [p["net_sales"] for p in document["top_products"]] == [199.99, 151.981, 59.98]
    assert document["churn_by_region"] == [
        {"region": "South", "customers": 2, "revenue_at_risk": 2172.192},
        {"region": "Northeast", "customers": 1, "revenue_at_risk": 1937.898},
    ]
    assert [a["days_of_supply"] for a in document["inventory_alerts"]] == [0, 150]
    assert set(document["inventory_alerts"][0]) == {
        "product", "category", "store_type", "qty_on_hand", "days_of_supply", "risk"
    }


def test_prompts(spark, context):
    areas = spark.createDataFrame([(a,) for a in [*V.INSIGHT_AREAS, "Weather"]], "InsightArea string")
    rows = {r.InsightArea: r.Prompt for r in insights.insight_prompts(areas, context, AS_OF).collect()}
    assert rows["Weather"] == rows["Overall"]
    assert len(set(rows.values())) == 4
    for area in V.INSIGHT_AREAS:
        assert rows[area].endswith(V.PROMPT_TASKS[area])
        assert "Today is March 03, 2026. Speak" in rows[area]
        figures = rows[area].split("JSON format:\n")[1]
        assert json.JSONDecoder().raw_decode(figures)[0]["summary"]["Period"] == "Current Month"


def test_saved_and_latest_insights(spark, context, warehouse):
    areas = insights.area_list(spark)

    def save(batch, when, texts):
        frame = spark.createDataFrame(texts, "InsightArea string, InsightText string")
        insights.save_insights(warehouse, insights.as_insights(frame, context, "m1", when), batch)

    save("a", dt.date(2026, 3, 2), [("Revenue", "old"), ("Churn", "old")])
    for _ in range(2):
        save("b", AS_OF, [("Revenue", "  zulu "), ("Revenue", "alpha"), ("Overall", "fine")])
    stored = warehouse.read("AIInsights")
    assert stored.count() == 5
    latest = {r.InsightArea: r.InsightText for r in insights.latest_insights(stored, areas).collect()}
    assert latest == {"Revenue": "alpha", "Churn": None, "Inventory": None, "Overall": "fine"}
    label = insights.insights_last_updated(stored).first()[0]
    assert label == "AI insights generated: Mar 03, 2026"
    assert json.loads(stored.first().KPIContext)["summary"]["TotalOrders"] == 3
