"""Loading staged sales."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tillspark import schemas as S
from tillspark.plans import sales_load
from tillspark.plans.sales_load import InvalidSaleError, load_sales

MEASURES = ["OrderID", "OrderLineID", "DateKey", "CustomerKey", "ProductKey", "StoreKey", "NetSales", "GrossProfit"]


def raw_rows(spark, *changes):
    """Valid sales of one product, each with some columns changed."""
    base = {
        "OrderID": "ORD-1",
        "OrderLineID": 1,
        "CustomerID": "CUST001",
        "ProductID": "PRD001",
        "StoreID": "STR001",
        "OrderDate": dt.date(2026, 3, 3),
        "Quantity": 1,
        "UnitPrice": Decimal("10.00"),
        "Discount": Decimal("0.00"),
        "ReturnFlag": False,
        "ProcessedFlag": False,
        "ProcessedDate": None,
    }
    rows = [{**base, **c} for c in changes]
    return spark.createDataFrame([tuple(r[f] for f in S.SALES_RAW.fieldNames()) for r in rows], S.SALES_RAW)


def no_facts(spark):
    return spark.createDataFrame([], S.FACT_SALES)


def facts_of(golden, raw, loaded):
    return sales_load.new_facts(raw, golden.customers, golden.products, golden.stores, loaded)


def test_load_reproduces_the_golden_fact(golden_warehouse, golden):
    counts = load_sales(golden_warehouse, golden.sales_raw(), AS_OF, "first")
    assert (counts.inserted, counts.rejected) == (11, 0)
    loaded = golden_warehouse.read("FactSales").select(MEASURES).collect()
    assert sorted(loaded) == sorted(golden.fact.select(MEASURES).collect())


def test_another_batch_with_the_same_lines_adds_nothing(golden_warehouse, golden):
    load_sales(golden_warehouse, golden.sales_raw(), AS_OF, "first")
    assert load_sales(golden_warehouse, golden.sales_raw(), AS_OF, "second").inserted == 0
    assert golden_warehouse.read("FactSales").count() == 11


def test_a_replayed_batch_replaces_itself(golden_warehouse, golden):
    raw = golden.sales_raw().unionByName(golden.sales_raw().withColumn("Quantity", F.lit(0)))
    for _ in range(2):
        counts = load_sales(golden_warehouse, raw, AS_OF, "first")
        assert (counts.inserted, counts.rejected) == (11, 11)
    assert golden_warehouse.read("FactSales").count() == 11
    assert golden_warehouse.read("SalesRejects").count() == 11


def test_rejects_and_silent_drops(spark, golden):
    raw = raw_rows(
        spark,
        {"OrderID": None},
        {"OrderID": "zero", "Quantity": 0},
        {"OrderID": "minus", "Quantity": -1},
        {"OrderID": "price", "UnitPrice": Decimal("-0.01")},
        {"OrderID": "no quantity", "Quantity": None},
        {"OrderID": "no price", "UnitPrice": None},
        {"OrderID": "free", "UnitPrice": Decimal("0.00")},
        {"OrderID": "customer", "CustomerID": "?"},
        {"OrderID": "product", "ProductID": None},
        {"OrderID": "store", "StoreID": "?"},
        {"OrderID": "loaded"},
        {"OrderID": "both", "Quantity": None, "UnitPrice": Decimal("-1.00")},
    )
    loaded = facts_of(golden, raw_rows(spark, {"OrderID": "loaded"}), no_facts(spark))
    rejected = sales_load.rejects(raw, AS_OF).collect()
    assert sorted(str(r.OrderID) for r in rejected) == ["None", "both", "minus", "price", "zero"]
    assert {r.RejectReason for r in rejected} == {"NULL OrderID or invalid Qty/Price"}
    facts = facts_of(golden, raw, loaded).collect()
    assert [(r.OrderID, r.NetSales) for r in facts] == [("free", 0)]

    dims = (golden.customers, golden.products, golden.stores)
    classified = sales_load.outcomes(raw, *dims, loaded)
    found = {r.Outcome: r.SalesLines for r in sales_load.outcome_counts(classified).collect()}
    assert found == {
        "rejected": 5,
        "missing quantity or price": 2,
        "loaded": 1,
        "unknown customer": 1,
        "unknown product": 1,
        "unknown store": 1,
        "already loaded": 1,
    }
    silent = {r.Outcome: r.SalesLines for r in sales_load.silent_drops(classified).collect()}
    assert silent == {k: v for k, v in found.items() if k not in ("rejected", "loaded", "already loaded")}


def test_copies_inside_a_batch_are_both_kept(spark, golden):
    raw = raw_rows(spark, {}, {})
    assert facts_of(golden, raw, no_facts(spark)).count() == 2


def test_a_missing_line_number_never_matches(spark, golden):
    raw = raw_rows(spark, {"OrderLineID": None})
    loaded = facts_of(golden, raw, no_facts(spark))
    assert facts_of(golden, raw, loaded).count() == 1


def test_defaults(spark, golden):
    row = facts_of(golden, raw_rows(spark, {"Discount": None, "ReturnFlag": None}), no_facts(spark)).first()
    assert (row.Discount, row.ReturnFlag, row.NetSales, row.COGS) == (0, False, 10, 45)


def test_marking_covers_rejected_rows_and_keeps_old_dates(spark):
    earlier = dt.datetime(2026, 1, 1)
    raw = raw_rows(spark, {"OrderID": None}, {"ProcessedFlag": True, "ProcessedDate": earlier})
    marked = sales_load.marked_processed(raw, AS_OF).collect()
    assert {r.ProcessedFlag for r in marked} == {True}
    assert sorted(r.ProcessedDate for r in marked) == [earlier, dt.datetime(2026, 3, 3)]


def test_unknown_dates_stop_the_load(spark, golden_warehouse):
    raw = raw_rows(spark, {}, {"OrderID": "late", "OrderDate": dt.date(2026, 5, 5)})
    with pytest.raises(InvalidSaleError):
        load_sales(golden_warehouse, raw, AS_OF, "first")
    assert golden_warehouse.read("FactSales").count() == 0


def test_unknown_dates_can_be_rejected(spark, golden_warehouse):
    raw = raw_rows(spark, {}, {"OrderID": "late", "OrderDate": dt.date(2026, 5, 5)})
    counts = load_sales(golden_warehouse, raw, AS_OF, "first", reject_invalid=True)
    assert (counts.inserted, counts.rejected) == (1, 1)
    assert golden_warehouse.read("SalesRejects").first().RejectReason == "Date not in calendar"


def test_an_unknown_date_on_an_unknown_customer_is_no_error(spark, golden_warehouse):
    raw = raw_rows(spark, {}, {"OrderID": "late", "OrderDate": dt.date(2026, 5, 5), "CustomerID": "?"})
    assert load_sales(golden_warehouse, raw, AS_OF, "first").inserted == 1


def test_a_missing_line_number_stops_the_load(spark, golden_warehouse):
    raw = raw_rows(spark, {}, {"OrderID": "lineless", "OrderLineID": None})
    with pytest.raises(InvalidSaleError, match="Line number missing"):
        load_sales(golden_warehouse, raw, AS_OF, "first")
    counts = load_sales(golden_warehouse, raw, AS_OF, "first", reject_invalid=True)
    assert (counts.inserted, counts.rejected) == (1, 1)
