"""Registered queries against a second engine, and the plans Spark makes for them."""

import datetime as dt
import os

import pytest

import __spark_entry__ as contract
from tillspark.checks.queries import QUERIES
from tillspark.sources.sample_tables import COLUMNS, SampleTables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODEL_OUTPUTS = {"churn_scores", "churn_evaluation", "churn_importance", "score_preview"}
LONG_JOBS = {"incremental_sales_load", "daily_refresh"}

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are missing")


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    for name in COLUMNS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return repr(value + 0.0) if isinstance(value, float) else repr(value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(contract.oracle_sql()) == MODEL_OUTPUTS
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(contract.oracle_sql()) - LONG_JOBS))
def test_query_matches_sql(spark, second_engine, name):
    result = contract.queries()[name](spark, FOLDER)
    text = plan(result)
    assert "CartesianProduct" not in text and "Python" not in text
    columns = sorted(result.columns)
    found = sorted(tuple(normal(v) for v in row) for row in result.select(*columns).collect())
    answer = second_engine.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(normal(row[i]) for i in order) for row in answer.fetchall())
    assert found == expected


def test_entry(spark):
    assert len(contract.entry(spark).schema) == 19


# --- plans ------------------------------------------------------------------

def test_dates_reach_the_scan(spark):
    sales = SampleTables(spark, FOLDER).sales(since=dt.date(2001, 7, 1))
    text = plan(sales)
    assert "GreaterThanOrEqual(o_orderdate,2001-07-01T00:00)" in text
    assert "LessThan(o_orderdate,2001-08-01T00:00)" in text


def test_unused_columns_are_not_read(spark):
    text = plan(contract.queries()["sales_summary"](spark, FOLDER))
    assert "l_tax" not in text and "l_shipdate" not in text and "c_acctbal" not in text
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_revenue_at_risk_alone_needs_no_distinct_counts(spark):
    text = plan(contract.queries()["churn_by_region"](spark, FOLDER))
    assert "Expand" not in text
