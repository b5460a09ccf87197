"""Column functions and rules at their boundaries."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark.functions import dates, money, rules


def evaluate(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    ("start", "end", "months"),
    [("2025-12-31", "2026-03-01", 3), ("2026-03-01", "2026-03-31", 0), ("2024-05-10", "2026-05-09", 24)],
)
def test_months_crossed(spark, start, end, months):
    rows = [(dt.date.fromisoformat(start), dt.date.fromisoformat(end))]
    assert evaluate(spark, "a date, b date", rows, dates.months_crossed(F.col("a"), F.col("b"))) == [months]


def test_date_keys(spark):
    rows = [(dt.date(2026, 3, 3),), (dt.date(1999, 12, 31),), (None,)]
    assert evaluate(spark, "d date", rows, dates.date_key(F.col("d"))) == [20260303, 19991231, None]
    assert evaluate(spark, "d date", rows, dates.key_date(dates.date_key(F.col("d")))) == [r[0] for r in rows]
    assert dates.date_key_of(dt.date(2026, 3, 3)) == 20260303


def test_months_before_clamps_to_the_month_end(spark):
    assert spark.range(1).select(dates.months_before(dt.date(2026, 8, 31), 6)).first()[0] == dt.date(2026, 2, 28)


def test_labels(spark):
    rows = [(dt.date(2026, 3, 3),)]
    assert evaluate(spark, "d date", rows, dates.long_date(F.col("d"))) == ["March 03, 2026"]
    assert evaluate(spark, "d date", rows, dates.short_date(F.col("d"))) == ["Mar 03, 2026"]


def test_safe_divide(spark):
    rows = [(6.0, 3.0), (6.0, 0.0), (6.0, None), (None, 3.0), (None, None)]
    column = money.safe_divide(F.col("a"), F.col("b"))
    assert evaluate(spark, "a double, b double", rows, column) == [2.0, 0.0, 0.0, None, 0.0]


def test_guarded_ratio(spark):
    rows = [(Decimal("1"), Decimal("3")), (Decimal("1"), Decimal("0")), (Decimal("1"), None)]
    column = money.percent_of(F.col("a"), F.col("b"))
    assert evaluate(spark, "a decimal(10,2), b decimal(10,2)", rows, column) == [Decimal("33.33"), None, None]


def test_unit_margin_is_zero_without_a_price(spark):
    rows = [(Decimal("0"), Decimal("5")), (None, Decimal("5")), (Decimal("10"), Decimal("4"))]
    column = money.unit_margin_percent(F.col("p"), F.col("c"))
    assert evaluate(spark, "p decimal(10,2), c decimal(10,2)", rows, column) == [0, 0, Decimal("60.00")]


def test_churn_category(spark):
    rows = [(Decimal(x),) if x else (None,) for x in ("0.6999", "0.7000", "0.3999", "0.4000", None)]
    column = rules.churn_category(F.col("p"))
    assert evaluate(spark, "p decimal(5,4)", rows, column) == ["Medium", "High", "Low", "Medium", "Low"]


def test_recommended_action(spark):
    rows = [("Low",), ("Medium",), ("High",), (None,)]
    found = evaluate(spark, "c string", rows, rules.recommended_action(F.col("c")))
    assert found == [
        "Standard nurture emails", "Targeted discount offer", "Immediate outreach + loyalty reward", None
    ]


def test_segment_score(spark):
    rows = [("Premium",), ("Regular",), ("At-Risk",), (None,)]
    assert evaluate(spark, "s string", rows, rules.segment_score(F.col("s"))) == [3, 2, 1, 1]


def test_revenue_at_risk(spark):
    value = Decimal("100.00")
    rows = [("High", value), ("Medium", value), ("Low", value), (None, value), ("High", None), ("Low", None)]
    column = rules.revenue_at_risk(F.col("c"), F.col("v"))
    expected = [Decimal("1020"), Decimal("540"), 0, 0, None, 0]
    assert evaluate(spark, "c string, v decimal(10,2)", rows, column) == expected


def test_stock_rules(spark):
    rows = [(0, 10), (10, 10), (11, 10), (30, 10), (31, 10), (-1, 10), (None, 10), (5, None)]
    schema = "q int, r int"
    risk = rules.stock_out_risk(F.col("q"), F.col("r"))
    flag = rules.is_overstocked(F.col("q"), F.col("r"))
    assert evaluate(spark, schema, rows, risk) == ["High", "Medium", "Low", "Low", "Low", "Medium", "Low", "Low"]
    assert evaluate(spark, schema, rows, flag) == [False, False, False, False, True, False, False, False]


def test_days_of_supply(spark):
    rows = [(79, 10.0), (100, None), (100, 0.0), (0, 3.0), (None, 3.0), (-79, 10.0)]
    column = rules.days_of_supply(F.col("q"), F.col("a"))
    assert evaluate(spark, "q int, a double", rows, column) == [7, 999, 999, 0, None, -7]


def test_overstock_cost_uses_twice_the_reorder_point(spark):
    rows = [(True, 31), (False, 31), (None, 31)]
    column = rules.overstock_cost(F.col("f"), F.lit(Decimal("2.00")), F.col("q"), F.lit(10))
    assert evaluate(spark, "f boolean, q int", rows, column) == [Decimal("22"), 0, 0]
