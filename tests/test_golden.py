"""Known results on the golden rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF, PRODUCTS
from tillspark.functions.money import unit_margin_percent
from tillspark.plans import customers, inventory, sales

# Net sales and gross profit per line, in order.
LINES = [
    ("259.98", "169.98"),
    ("49.491", "31.491"),
    ("79.99", "51.99"),
    ("189.9905", "129.9905"),
    ("249.99", "174.99"),
    ("152.983", "88.983"),
    ("119.97", "83.97"),
    ("116.991", "71.991"),
    ("59.98", "43.98"),
    ("199.99", "139.99"),
    ("151.981", "95.981"),
]
# orders, spend, average, days, categories of customers 1..8
ACTIVITY = [
    (2, "509.46", "169.82", 0, 2),
    (1, "79.99", "79.99", 47, 1),
    (1, "189.99", "189.99", 47, 1),
    (2, "401.97", "200.99", 0, 2),
    (1, "152.98", "152.98", 30, 1),
    (1, "119.97", "119.97", 16, 1),
    (1, "116.99", "116.99", 16, 1),
    (1, "59.98", "59.98", 2, 1),
]
AT_RISK = {
    "CUST001": "0",
    "CUST002": "431.9460",
    "CUST003": "1937.8980",
    "CUST004": "0",
    "CUST005": "1560.3960",
    "CUST006": "647.8380",
    "CUST007": "0",
    "CUST008": "611.7960",
}


@pytest.fixture(scope="module")
def activity(golden):
    return customers.customer_activity(
        golden.customers, golden.fact, golden.dates, golden.products, golden.tickets, AS_OF
    )


@pytest.fixture(scope="module")
def dashboard(golden, activity):
    return customers.churn_dashboard(golden.customers, activity)


def test_line_measures(golden):
    rows = golden.fact.orderBy("OrderID", "OrderLineID").collect()
    assert [(r.NetSales, r.GrossProfit) for r in rows] == [(Decimal(n), Decimal(p)) for n, p in LINES]
    assert sum(r.NetSales for r in rows) == Decimal("1631.3365")


def test_product_margins(golden):
    rows = golden.products.orderBy("ProductKey").select(unit_margin_percent(F.col("UnitPrice"), F.col("UnitCost")))
    assert [r[0] for r in rows.collect()] == [Decimal(p[7]) for p in PRODUCTS]


def test_sales_summary(golden):
    summary = sales.sales_summary(golden.fact, golden.dates, golden.stores, golden.products, golden.customers)
    rows = summary.collect()
    assert len(rows) == 11
    assert {r.OrderCount for r in rows} == {1}
    assert summary.columns[:5] == ["Year", "Quarter", "MonthNumber", "MonthName", "FullDate"]
    assert sum(r.NetSales for r in rows) == Decimal("1631.3365")


def test_customer_activity(activity):
    rows = activity.orderBy("CustomerKey").collect()
    found = [
        (r.TotalOrders, r.TotalSpend, r.AvgOrderValue, r.DaysSinceLastPurchase, r.UniqueCategories) for r in rows
    ]
    assert found == [(o, Decimal(s), Decimal(a), d, c) for o, s, a, d, c in ACTIVITY]
    assert {r.SupportTickets for r in rows} == {0}


def test_revenue_at_risk(dashboard):
    found = {r.CustomerID: r.RevenueAtRisk for r in dashboard.collect()}
    assert found == {c: Decimal(v) for c, v in AT_RISK.items()}


def test_churn_by_region(dashboard):
    rows = [tuple(r) for r in customers.churn_by_region(dashboard).collect()]
    assert rows == [("South", 2, Decimal("2172.1920")), ("Northeast", 1, Decimal("1937.8980"))]


def test_kpi_summary(spark, golden, dashboard):
    none = inventory.inventory_intelligence(
        spark.createDataFrame([], "DateKey int, ProductKey long, StoreKey long, QuantityOnHand int, ReorderPoint int,"
                                  " DaysOfSupply int, StockOutRisk string, OverstockFlag boolean"),
        golden.products,
        golden.stores,
        golden.dates,
    )
    row = sales.kpi_summary(golden.fact, golden.customers, dashboard, none, AS_OF).first()
    assert row.Period == "Current Month"
    assert row.TotalRevenue == Decimal("411.951")
    assert row.TotalGrossProfit == Decimal("279.951")
    assert row.GrossMarginPct == Decimal("67.96")
    assert (row.TotalOrders, row.ActiveCustomers, row.HighChurnCustomers, row.HighStockOutSKUs) == (3, 3, 3, 0)
    assert row.AvgRevenuePerCustomer == Decimal("137.32")
    assert row.TotalRevenueAtRisk == Decimal("4110.09")


def test_kpi_summary_without_sales(golden, dashboard):
    empty = golden.fact.filter("false")
    stock = golden.products.selectExpr("'Low' AS StockOutRisk")
    row = sales.kpi_summary(empty, golden.customers, dashboard, stock, AS_OF).first()
    assert (row.TotalRevenue, row.GrossMarginPct, row.AvgRevenuePerCustomer) == (None, None, None)
    assert (row.TotalOrders, row.ActiveCustomers) == (0, 0)


def test_top_product_groups(golden):
    rows = sales.top_product_groups(golden.fact, golden.products, AS_OF).collect()
    assert [(r.Category, r.SubCategory, r.NetSales) for r in rows] == [
        ("Electronics", "Smart Home", Decimal("199.99")),
        ("Appliances", "Kitchen", Decimal("151.981")),
        ("Home", "Kitchen", Decimal("59.98")),
    ]
