"""Joins, numbering, quantiles, grouping codes, checks and updates."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillspark import schemas as S
from tillspark.operators import checks, joins, ranking, updates
from tillspark.operators.grouping import group_codes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """A stored frame, whose size Spark knows."""

    def store(df, name):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return store


# --- joins ------------------------------------------------------------------
@pytest.mark.parametrize(("text", "size"), [("10485760b", 10485760), ("10MB", 10 << 20), ("-1", -1), ("2g", 2 << 30), ("1t", 1 << 40)])
def test_broadcast_limit(spark, text, size):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert joins.broadcast_limit(spark) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_broadcasts_by_size(spark, stored):
    fact = stored(spark.range(1000).selectExpr("id", "id % 10 AS k"), "fact")
    dim = stored(spark.range(10).selectExpr("id AS k", "id * 2 AS v"), "dim")
    assert "BroadcastHashJoin" in plan(joins.lookup(fact, dim, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        joined = joins.lookup(fact, dim, "k")
        assert "BroadcastHashJoin" not in plan(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_not_in_is_an_anti_join_behind_a_reduced_history(spark, stored):
    rows = stored(spark.range(5).selectExpr("id AS a", "CAST(id AS INT) AS b"), "rows")
    present = stored(spark.range(3, 1000).selectExpr("id AS a", "CAST(id AS INT) AS b", "'x' AS wide"), "present")
    left = joins.not_in(rows, present, ["a", "b"])
    assert sorted(r.a for r in left.collect()) == [0, 1, 2]
    text = plan(left)
    assert "LeftAnti" in text and "LeftSemi" in text
    assert "wide" not in text


# --- numbering --------------------------------------------------------------
@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_numbered_is_dense_and_repeatable(spark, buckets):
    df = spark.range(500).selectExpr("id", "id % 3 AS g").repartition(7)
    first = ranking.numbered(df, ["id"], by=["g"], buckets=buckets).collect()
    again = ranking.numbered(df.coalesce(1), ["id"], by=["g"], buckets=buckets).collect()
    assert sorted(first) == sorted(again)
    for g in range(3):
        numbers = sorted(r.RowNumber for r in first if r.g == g)
        assert numbers == list(range(1, len(numbers) + 1))


def test_numbered_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1), (4, 1)], "id int, g int")
    rows = ranking.numbered(df, ["id"], by=["g"]).collect()
    assert sorted((r.g is None, r.RowNumber) for r in rows) == [(False, 1), (False, 2), (True, 1), (True, 2)]


def test_numbered_without_groups(spark):
    numbers = [r.RowNumber for r in ranking.numbered(spark.range(100), ["id"], buckets=8).collect()]
    assert sorted(numbers) == list(range(1, 101))


# --- quantiles --------------------------------------------------------------
def samples():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() * 1000 for _ in range(3000)],
        "one value holds a third": [5.0] * 1000 + [rng.random() * 10 for _ in range(2000)],
        "two values": [0.0] * 1500 + [9.0] * 1500,
        "tie at the cap": [rng.random() for _ in range(2960)] + [2.0] * 40,
        "one row": [3.5],
    }


@pytest.mark.parametrize("name", samples())
def test_quantiles_are_exact(spark, name):
    values = samples()[name] + [-3.25]
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "x double, y double").repartition(4)
    for q in (0.0, 0.25, 0.99, 1.0):
        found = ranking.quantiles(df, ["x", "y"], q)
        x, y = df.select(found["x"], found["y"]).first()
        assert x == pytest.approx(float(np.quantile(values, q)), abs=1e-9)
        assert y == pytest.approx(float(np.quantile([-v for v in values], q)), abs=1e-9)


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles"))


def test_quantiles_run_nothing_while_they_are_planned(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y")
    spark.sparkContext.setJobGroup("quantiles", "")
    try:
        caps = ranking.quantiles(df, ["x", "y"], 0.99)
        frame = df.select(caps["x"], caps["y"])
        assert jobs(spark) == 0
        assert tuple(frame.first()) == (990.0, 6.0)
        assert jobs(spark) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_quantile_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "x double")
    one = spark.range(1).select(ranking.quantiles(empty, ["x"], 0.99)["x"].alias("x"))
    assert one.first().x is None


# --- grouping codes ---------------------------------------------------------
def test_group_codes_keep_nulls_apart(spark):
    dim = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", None), (3, "a", "x"), (4, None, None), (5, "a", None)], "k int, p string, q string"
    )
    per_key, per_code = group_codes(dim, "k", ["p", "q"], "code")
    assert {tuple(r) for r in per_key.collect()} == {(1, 1), (3, 1), (2, 2), (5, 2), (4, 4)}
    assert {(r.code, r.p, r.q) for r in per_code.collect()} == {(1, "a", "x"), (2, "a", None), (4, None, None)}


# --- checks -----------------------------------------------------------------
def test_orphans_count_rows_and_ignore_null_keys(spark):
    fact = spark.createDataFrame([(1, 1), (1, 9), (7, 9), (7, None)], "A int, B int")
    dims = {"DimA": spark.createDataFrame([(1,)], "A int"), "DimB": spark.createDataFrame([(1,)], "B int")}
    rows = checks.orphans(fact, dims, {"A": "DimA", "B": "DimB"}).collect()
    assert [tuple(r) for r in rows] == [("A", "DimA", 1, 2), ("B", "DimB", 1, 2)]


def test_every_declared_foreign_key_names_a_column(golden):
    assert set(S.SALES_FOREIGN_KEYS) <= set(golden.fact.columns)
    dims = {"DimDate": golden.dates, "DimCustomer": golden.customers, "DimProduct": golden.products,
            "DimStore": golden.stores}
    assert {r.OrphanRows for r in checks.orphans(golden.fact, dims, S.SALES_FOREIGN_KEYS).collect()} == {0}


def test_duplicate_keys(spark):
    tables = {"T": spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "x int, y string")}
    rows = checks.duplicate_keys(tables, {"T": ["x", "y"]}).collect()
    assert [tuple(r) for r in rows] == [("T", "1|a", 2)]


def test_missing_values(spark):
    tables = {"T": spark.createDataFrame([(1, None), (None, None)], "x int, y string")}
    rows = checks.missing_values(tables, {"T": ["x", "y"]}).collect()
    assert [tuple(r) for r in rows] == [("T", "x", 1), ("T", "y", 2)]


# --- updates ----------------------------------------------------------------
def test_update_matched_leaves_the_rest_alone(spark):
    target = spark.createDataFrame([("a", 1, None), ("b", 2, "old"), ("c", 3, None)], "id string, n int, v string")
    changes = spark.createDataFrame([("a", "new"), ("b", None), ("z", "?")], "id string, w string")
    rows = updates.update_matched(target, changes, "id", {"v": F.col("w")}).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("a", 1, "new"), ("b", 2, None), ("c", 3, None)]


def test_require_unique(spark):
    updates.require_unique(spark.range(3), ["id"])
    with pytest.raises(updates.DuplicateKeyError):
        updates.require_unique(spark.range(3).union(spark.range(1)), ["id"])


def test_upsert_overwrites_adds_and_numbers(spark, golden):
    columns = S.CUSTOMER_EXTRACT.fieldNames()
    known = golden.customers.filter("CustomerKey <= 6")
    extract = golden.customers.select(columns).withColumn("City", F.lit("Moved"))
    merged = updates.upsert_type1(
        known, extract.union(extract), "CustomerID", "CustomerKey", {"IsActive": F.lit(True)}
    )
    rows = {r.CustomerID: r for r in merged.collect()}
    assert merged.count() == 8
    assert {r.City for r in rows.values()} == {"Moved"}
    assert sorted(r.CustomerKey for r in rows.values()) == list(range(1, 9))
    assert rows["CUST003"].ChurnRiskScore == Decimal("0.7800")
    assert (rows["CUST008"].IsActive, rows["CUST008"].ChurnRiskScore) == (True, None)
    assert rows["CUST008"].CustomerKey in (7, 8)


def test_upsert_into_an_empty_dimension(spark, golden):
    empty = spark.createDataFrame([], S.DIM_CUSTOMER)
    extract = golden.customers.select(S.CUSTOMER_EXTRACT.fieldNames())
    merged = updates.upsert_type1(empty, extract, "CustomerID", "CustomerKey", {})
    assert sorted(r.CustomerKey for r in merged.collect()) == list(range(1, 9))
