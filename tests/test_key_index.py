"""The key index of sales: what a load opens, and that it never loses or doubles a line."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tests.test_sales_load import raw_rows
from tillspark import schemas as S
from tillspark.plans import sales_load
from tillspark.plans.sales_load import load_sales
from tillspark.session import work_dir


def orders(spark, names, line=1):
    """Stored sales, as a load has them: their size is known."""
    path = f"{work_dir(spark)}/orders-{uuid.uuid4().hex}"
    raw_rows(spark, *[{"OrderID": n, "OrderLineID": line} for n in names]).coalesce(1).write.parquet(path)
    return spark.read.schema(S.SALES_RAW).parquet(path)


def fact_keys(warehouse):
    return sorted((r["OrderID"], r["OrderLineID"]) for r in warehouse.read("FactSales").select("OrderID", "OrderLineID").collect())


def test_a_load_reads_no_facts_and_opens_few_buckets(spark, golden_warehouse):
    old = [f"OLD-{i}" for i in range(300)]
    load_sales(golden_warehouse, orders(spark, old[:150]), AS_OF, "one")
    load_sales(golden_warehouse, orders(spark, old[150:]), AS_OF, "two")
    index = golden_warehouse.key_index("FactSales")
    everything = index.files(index._may_hold(orders(spark, old).select(*index.keys), golden_warehouse._published("FactSales")))
    assert len(everything) > index.buckets

    batch = orders(spark, ["OLD-7", *[f"NEW-{i}" for i in range(20)]])
    seen = index.seen(batch)
    assert {tuple(r) for r in seen.filter("OrderID like 'OLD-7'").collect()} == {("OLD-7", 1)}
    opened = seen.inputFiles()
    assert 1 <= len(opened) <= 4
    facts = sales_load.new_facts(batch, *(golden_warehouse.read(f"Dim{n}") for n in ("Customer", "Product", "Store")), seen)
    assert not [f for f in facts.inputFiles() if "/FactSales/" in f]
    assert load_sales(golden_warehouse, batch, AS_OF, "three").inserted == 20


def test_filters_have_no_false_negatives_and_few_false_positives(spark, golden_warehouse):
    rng = random.Random(3)
    known = [f"K-{rng.randrange(10**9)}" for _ in range(4000)]
    index = golden_warehouse.key_index("FactSales")
    keys = spark.createDataFrame([(k, i % 3) for i, k in enumerate(known)], index.columns)
    index.write(keys, "b", 1)
    published = spark.createDataFrame([("b", 1)], "BatchID string, Attempt int")
    found = {r["KeyBucket"] for r in index._may_hold(keys, published).collect()}
    assert found == {r[0] for r in keys.select(F.pmod(F.hash(*index.keys), F.lit(index.buckets))).distinct().collect()}
    hits = sum(index._may_hold(spark.createDataFrame([(f"X-{i}", 1)], index.columns), published).count() for i in range(12))
    assert hits <= 2


def test_filters_that_say_yes_to_everything_lose_nothing(spark, golden_warehouse):
    load_sales(golden_warehouse, orders(spark, ["A", "B"]), AS_OF, "one")
    index = golden_warehouse.key_index("FactSales")
    full = index._all_filters().withColumn("Bits", F.unhex(F.lit("FF" * 4096)))
    rows = full.collect()
    spark.createDataFrame(rows, full.schema).write.mode("overwrite").partitionBy("BatchID", "Attempt").parquet(f"{index.root}/filters")
    assert load_sales(golden_warehouse, orders(spark, ["A", "C", "D"]), AS_OF, "two").inserted == 2
    assert fact_keys(golden_warehouse) == [("A", 1), ("B", 1), ("C", 1), ("D", 1)]


@pytest.mark.parametrize("limit", ["-1", "64MB"])
def test_replays_other_lines_and_batches(spark, golden_warehouse, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert load_sales(golden_warehouse, orders(spark, ["A", "B"]), AS_OF, "one").inserted == 2
        assert load_sales(golden_warehouse, orders(spark, ["A", "C"]), AS_OF, "two").inserted == 1
        assert load_sales(golden_warehouse, orders(spark, ["A"], line=2), AS_OF, "three").inserted == 1
        # A replay of the first batch without B: only what is published counts.
        assert load_sales(golden_warehouse, orders(spark, ["A"]), AS_OF, "one").inserted == 1
        assert load_sales(golden_warehouse, orders(spark, ["B", "A"]), AS_OF, "four").inserted == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert fact_keys(golden_warehouse) == [("A", 1), ("A", 2), ("B", 1), ("C", 1)]


def test_without_broadcasts_the_history_is_not_shuffled(spark, golden_warehouse):
    load_sales(golden_warehouse, orders(spark, [f"OLD-{i}" for i in range(50)]), AS_OF, "one")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = golden_warehouse.key_index("FactSales")
        batch = orders(spark, ["OLD-1", "NEW"])
        published = spark.createDataFrame([("one", 1)], "BatchID string, Attempt int")
        history = index._keys(published.hint("broadcast"))
        plan = batch.join(history, index.keys, "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "keys_" in line)
    above = plan.splitlines()[:scan]
    depth = plan.splitlines()[scan].index("FileScan")
    on_the_way = []
    for line in reversed(above):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            on_the_way.append(line)
            depth = at
    assert not [x for x in on_the_way if "Exchange hashpartitioning" in x], plan


def test_a_warehouse_from_before_the_index_is_indexed_first(spark, golden_warehouse, monkeypatch):
    from tillspark.sources import warehouse as w

    indexed = dict(w.INDEXED)
    w.INDEXED.clear()
    try:
        facts = sales_load.new_facts(orders(spark, ["A", "B"]), *(golden_warehouse.read(f"Dim{n}") for n in ("Customer", "Product", "Store")), spark.createDataFrame([], "OrderID string, OrderLineID int"))
        golden_warehouse.put_batches({"FactSales": facts, "SalesRejects": spark.createDataFrame([], S.SALES_REJECTS)}, "early")
    finally:
        w.INDEXED.update(indexed)
    assert load_sales(golden_warehouse, orders(spark, ["B", "C"]), AS_OF, "late").inserted == 1
    assert fact_keys(golden_warehouse) == [("A", 1), ("B", 1), ("C", 1)]


def test_an_attempt_that_broke_off_leaves_no_keys(spark, golden_warehouse):
    index = golden_warehouse.key_index("FactSales")
    index.write(spark.createDataFrame([("A", 1), ("Z", 1)], index.columns), "one", 1)
    assert load_sales(golden_warehouse, orders(spark, ["A"]), AS_OF, "one").inserted == 1
    assert load_sales(golden_warehouse, orders(spark, ["Z"]), AS_OF, "two").inserted == 1


def test_batch_names_with_signs(spark, golden_warehouse):
    load_sales(golden_warehouse, orders(spark, ["A"]), AS_OF, "day 'x' 2026-03-03")
    load_sales(golden_warehouse, orders(spark, ["B"]), AS_OF, "second")
    assert load_sales(golden_warehouse, orders(spark, ["A", "B", "C"]), AS_OF, "day 2026-03-04").inserted == 1
    assert fact_keys(golden_warehouse) == [("A", 1), ("B", 1), ("C", 1)]
