"""What writes leave on disk, and what the shuffles before them move."""

import glob
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tillspark import schemas as S
from tillspark.operators import joins
from tillspark.plans import customers, sales, sales_load
from tillspark.session import SHUFFLES_GO
from tillspark.sources import extracts

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def limited(spark):
    """Set the size up to which dimensions are broadcast."""
    before = spark.conf.get(LIMIT)
    yield lambda text: spark.conf.set(LIMIT, text)
    spark.conf.set(LIMIT, before)


def shuffle_files():
    return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def dealt(df):
    """Rows from a shuffle."""
    return df.repartition(3, df.columns[0])


def test_shuffle_files_go_with_each_write(spark, golden, warehouse, tmp_path):
    before, setting = shuffle_files(), spark.conf.get(SHUFFLES_GO)
    stock = golden.products.select(F.lit(20260303).alias("DateKey"), "ProductKey", *[F.lit(1).alias(c) for c in S.FACT_INVENTORY.fieldNames()[2:6]], F.lit("Low").alias("StockOutRisk"), F.lit(True).alias("OverstockFlag"))
    warehouse.replace("DimCustomer", dealt(golden.customers))
    warehouse.staged("Some", dealt(golden.customers))
    warehouse.put_batch("FactSales", dealt(golden.fact), "one")
    warehouse.put_snapshot("FactInventory", stock)
    extracts.write_extract(dealt(golden.customers), str(tmp_path / "customers.csv"))
    for _ in range(20):
        # Checks and pointers are single rows and numbers; what was written is not among them.
        left = sum(len(open(f, "rb").read()) for f in shuffle_files() - before if f.endswith(".data"))
        if left < 2000:
            break
        time.sleep(0.1)
    assert left < 2000
    assert spark.conf.get(SHUFFLES_GO) == setting
    assert warehouse.read("FactSales").count() == golden.fact.count()


def test_a_failed_write_restores_the_setting(spark, warehouse):
    setting = spark.conf.get(SHUFFLES_GO)
    bad = spark.range(1).select(F.raise_error(F.lit("no")).alias("UserEmail"), F.lit("South").alias("Region"))
    with pytest.raises(Exception, match="no"):
        warehouse.replace("UserRegions", bad)
    assert spark.conf.get(SHUFFLES_GO) == setting


def test_measures_are_computed_behind_the_shuffle(golden, warehouse):
    dealt_rows = []

    def derive(rows):
        dealt_rows.append(rows)
        return sales_load.with_measures(rows)

    warehouse.put_batch("FactSales", golden.fact, "whole")
    whole = {str(r) for r in warehouse.read("FactSales").drop("BatchID").collect()}
    warehouse.put_batch("FactSales", golden.fact.drop(*sales_load.MEASURES), "whole", derive)
    assert {str(r) for r in warehouse.read("FactSales").drop("BatchID").collect()} == whole
    (rows,) = dealt_rows
    assert plan(rows).startswith("RebalancePartitions") and not set(sales_load.MEASURES) & set(rows.columns)


def test_a_load_deals_out_no_measures(golden, golden_warehouse, monkeypatch):
    given, put = [], golden_warehouse.put_batches

    def spy(frames, *rest):
        given.append(frames["FactSales"].columns)
        put(frames, *rest)

    monkeypatch.setattr(golden_warehouse, "put_batches", spy)
    assert sales_load.load_sales(golden_warehouse, golden.sales_raw(), AS_OF, "one").inserted == golden.fact.count()
    assert [set(S.FACT_SALES.fieldNames()) - set(c) for c in given] == [set(sales_load.MEASURES)]


def test_few_rows_are_broadcast_whatever_their_files_take(spark, tmp_path, monkeypatch, limited):
    spark.range(50).selectExpr("id AS k", "repeat(uuid(), 50) AS wide").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim")).select("k")
    limited("1KB")
    assert joins.if_small(dim) is dim
    assert "strategy=broadcast" in plan(spark.range(100).selectExpr("id AS k").join(joins.if_few(dim), "k"))
    monkeypatch.setattr(joins, "FEW_ROWS", 49)
    assert joins.if_few(dim) is dim
    monkeypatch.setattr(joins, "FEW_ROWS", 50)
    limited("-1")
    assert joins.if_few(dim) is dim


def test_sales_are_not_shuffled_to_meet_few_products(golden, golden_warehouse, limited):
    limited("1b")
    read = golden_warehouse.read
    golden_warehouse.put_batch("FactSales", golden.fact, "one")
    fact, products, stores = read("FactSales"), read("DimProduct"), read("DimStore")
    raw = golden_warehouse.replace("SalesRaw", golden.sales_raw())
    none = golden.spark.createDataFrame([], S.FACT_SALES)
    frames = {
        "facts": (sales_load.new_facts(raw, read("DimCustomer"), products, stores, none), 2),
        "summary": (sales.sales_groups(fact, stores, products, read("DimCustomer")), 2),
        "activity": (customers.customer_activity(read("DimCustomer"), fact, read("DimDate"), products, golden.tickets, AS_OF), 1),
    }
    for name, (df, hints) in frames.items():
        assert plan(df).count("strategy=broadcast") >= hints, name
        assert df.count() > 0


def test_compressed_extracts_are_read_like_plain_ones(spark, golden, tmp_path):
    lines = golden.customers.select(S.CUSTOMER_EXTRACT.fieldNames())
    for name, codec in (("plain", "none"), ("packed", "gzip")):
        extracts.write_extract(lines, str(tmp_path / name / "customers.csv"), codec)
    plain, packed = (
        sorted(map(str, extracts.read_extract(spark, str(tmp_path / n), extracts.CUSTOMER_FILES, S.CUSTOMER_EXTRACT).collect())) for n in ("plain", "packed")
    )
    assert plain == packed and len(plain) == lines.count()
    assert {f.name[-7:] for f in (tmp_path / "packed" / "customers.csv").glob("part-*")} == {".csv.gz"}


@pytest.mark.parametrize(("size", "written"), [("64MB", 0), ("1b", 1)])
def test_a_large_load_writes_its_new_lines_before_the_next_shuffle(golden, golden_warehouse, limited, monkeypatch, size, written):
    limited(size)
    raw = golden_warehouse.replace("SalesRaw", golden.sales_raw())
    first = raw.filter("OrderLineID = 1 AND OrderID < 'ORD-2026-0005'")
    staged, stage = [], golden_warehouse.staged
    monkeypatch.setattr(golden_warehouse, "staged", lambda name, df: staged.append(name) or stage(name, df))
    old = sales_load.load_sales(golden_warehouse, first, AS_OF, "one").inserted
    assert old and not staged
    assert sales_load.load_sales(golden_warehouse, raw, AS_OF, "two").inserted == golden.fact.count() - old
    assert staged == ["NewSales"] * written
    columns = [c for c in S.FACT_SALES.fieldNames() if c != "COGS" and c != "GrossProfit"]
    found = golden_warehouse.read("FactSales").select(columns)
    assert found.exceptAll(golden.fact.select(columns)).isEmpty() and found.count() == golden.fact.count()
