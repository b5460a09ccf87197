"""Storage, extracts, the streaming load and the whole day."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.golden_rows import AS_OF
from tillspark import schemas as S
from tillspark.operators.joins import scanned_bytes
from tillspark.plans import daily, views
from tillspark.session import work_dir
from tillspark.sources import extracts
from tillspark.streaming.arrivals import load_arrivals

HEADER = "OrderID,OrderLineID,CustomerID,ProductID,StoreID,OrderDate,Quantity,UnitPrice,Discount,ReturnFlag"


def write_sales(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


# --- storage ----------------------------------------------------------------
def test_a_table_can_be_computed_from_itself(spark, warehouse):
    assert warehouse.read("Targets").count() == 0
    assert scanned_bytes(warehouse.read("Targets")) < 1000
    for expected in (1, 2, 4):
        old = warehouse.read("Targets")
        one = spark.createDataFrame([(3, 2026, Decimal("1.00"))], S.TARGETS)
        warehouse.replace("Targets", old.union(old) if old.count() else one)
        assert warehouse.read("Targets").count() == expected


def test_readers_keep_the_version_they_opened(spark, warehouse):
    warehouse.replace("UserRegions", spark.createDataFrame([("a", "South")], S.USER_REGIONS))
    opened = warehouse.read("UserRegions")
    warehouse.replace("UserRegions", spark.createDataFrame([("b", "East")], S.USER_REGIONS))
    assert opened.first().UserEmail == "a"
    assert warehouse.read("UserRegions").first().UserEmail == "b"


def test_snapshots_replace_their_own_day(spark, warehouse):
    def snapshot(day, rows):
        return spark.createDataFrame([(day, i, 1, 5, 1, 999, "Low", True) for i in range(rows)], S.FACT_INVENTORY)

    for day, rows in ((20260302, 3), (20260303, 5), (20260303, 4)):
        warehouse.put_snapshot("FactInventory", snapshot(day, rows))
    found = {r.DateKey: r["count"] for r in warehouse.read("FactInventory").groupBy("DateKey").count().collect()}
    assert found == {20260302: 3, 20260303: 4}


def test_a_batch_is_seen_as_a_whole_or_not_at_all(golden_warehouse, golden, monkeypatch):
    from tillspark.plans.sales_load import rejects

    log = rejects(golden.sales_raw().withColumn("Quantity", F.lit(0)), AS_OF)
    publish = golden_warehouse._publish

    def broken(pointer, number):
        raise OSError("no space left")

    monkeypatch.setattr(golden_warehouse, "_publish", broken)
    with pytest.raises(OSError):
        golden_warehouse.put_batches({"FactSales": golden.fact, "SalesRejects": log}, "b1")
    assert golden_warehouse.read("FactSales").count() == golden_warehouse.read("SalesRejects").count() == 0
    monkeypatch.setattr(golden_warehouse, "_publish", publish)
    for _ in range(2):
        golden_warehouse.put_batches({"FactSales": golden.fact, "SalesRejects": log}, "b1")
        assert golden_warehouse.read("FactSales").count() == golden.fact.count()
        assert golden_warehouse.read("SalesRejects").count() == log.count() > 0


def test_the_fact_is_pruned_by_month(golden_warehouse, golden):
    from tillspark.plans.sales import current_month

    golden_warehouse.put_batch("FactSales", golden.fact, "first")
    month = current_month(golden_warehouse.read("FactSales"), AS_OF)
    text = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "SaleMonth" in text.split("PartitionFilters")[1].split("]")[0]
    assert month.count() == 3


def test_work_dir_is_under_the_shared_folder(spark):
    assert work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


# --- extracts ---------------------------------------------------------------
def test_extract_takes_matching_files_of_one_folder(spark, tmp_path):
    write_sales(tmp_path, "sales_1.csv", "A,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0")
    write_sales(tmp_path, "sales_2.csv", "B,x,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,1")
    write_sales(tmp_path, "other.csv", "C,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0")
    write_sales(tmp_path / "old", "sales_0.csv", "D,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0")
    rows = extracts.read_extract(spark, str(tmp_path), extracts.SALES_FILES, S.SALES_EXTRACT).collect()
    found = {r.OrderID: r for r in rows}
    assert set(found) == {"A", "B"}
    assert found["A"].UnitPrice == Decimal("10.00") and found["A"][extracts.CORRUPT] is None
    assert found["B"].OrderLineID is None and found["B"][extracts.CORRUPT].startswith("B,x")


def test_columns_are_found_by_name(spark, tmp_path):
    write_sales(tmp_path, "sales_1.csv", "A,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0")
    moved = "StoreID,ProductID,Extra,OrderID,OrderLineID,CustomerID,OrderDate,UnitPrice,Quantity,Discount,ReturnFlag"
    (tmp_path / "sales_2.csv").write_text(f"{moved}\nSTR001,PRD001,x,B,2,CUST001,2026-03-03,10.00,3,0,1\n")
    rows = extracts.read_extract(spark, str(tmp_path), extracts.SALES_FILES, S.SALES_EXTRACT).collect()
    found = {r.OrderID: r for r in rows}
    assert (found["B"].StoreID, found["B"].ProductID, found["B"].Quantity) == ("STR001", "PRD001", 3)
    assert (found["A"].StoreID, found["A"].ProductID, found["A"].Quantity) == ("STR001", "PRD001", 1)
    (tmp_path / "sales_3.csv").write_text("OrderID,OrderLineID\nC,1\n")
    with pytest.raises(extracts.MissingColumnError, match="StoreID"):
        extracts.read_extract(spark, str(tmp_path), extracts.SALES_FILES, S.SALES_EXTRACT)


# --- streaming --------------------------------------------------------------
@pytest.mark.parametrize("reject", [False, True])
def test_unreadable_lines_never_load(golden_warehouse, tmp_path, reject):
    good = "A,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0"
    bad = ["B,1,CUST001,PRD001,STR001,2026-03-03,many,10.00,0,0", "C,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,abc,0"]
    write_sales(tmp_path / "landing", "sales_1.csv", good, *bad)
    arguments = golden_warehouse, str(tmp_path / "landing"), str(tmp_path / "checkpoint"), AS_OF, "s"
    if not reject:
        with pytest.raises(Exception, match="2 lines do not fit"):
            load_arrivals(*arguments)
        assert golden_warehouse.read("FactSales").count() == golden_warehouse.read("SalesRejects").count() == 0
        return
    load_arrivals(*arguments, reject_invalid=True)
    assert [r.OrderID for r in golden_warehouse.read("FactSales").collect()] == ["A"]
    logged = {r.OrderID: r.RejectReason for r in golden_warehouse.read("SalesRejects").collect()}
    assert logged == {line[0]: f"Line not readable: {line}" for line in bad}


def test_readable_lines_are_staged_once(golden_warehouse, tmp_path, monkeypatch):
    write_sales(tmp_path / "landing", "sales_1.csv", "A,1,CUST001,PRD001,STR001,2026-03-03,1,10.00,0,0")
    staged = []
    monkeypatch.setattr(type(golden_warehouse), "staged", lambda self, name, df: staged.append(name))
    load_arrivals(golden_warehouse, str(tmp_path / "landing"), str(tmp_path / "checkpoint"), AS_OF, "s")
    assert golden_warehouse.read("FactSales").count() == golden_warehouse.read("SalesRaw").count() == 1
    assert not staged


def test_files_load_once(spark, golden_warehouse, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")

    def run(stream="s"):
        load_arrivals(golden_warehouse, str(landing), checkpoint, AS_OF, stream)
        return golden_warehouse.read("FactSales").count()

    line = "{},1,CUST001,PRD001,STR001,2026-03-03,{},10.00,0,0".format
    write_sales(landing, "sales_1.csv", line("A", 1), line("B", 2))
    assert run() == 2
    assert run() == 2
    write_sales(landing, "sales_2.csv", line("A", 1), line("C", 3), line("D", 0))
    write_sales(landing, "notes.csv", line("E", 1))
    assert run() == 3
    assert golden_warehouse.read("SalesRejects").count() == 1
    assert golden_warehouse.read("SalesRaw").filter("NOT ProcessedFlag").count() == 0
    # A lost checkpoint reads all files again; lines loaded under the old name stay single.
    checkpoint = str(tmp_path / "another")
    assert run("t") == 3


# --- the whole day ----------------------------------------------------------
@pytest.fixture
def landing(golden, tmp_path):
    folder = tmp_path / "landing"
    flags = golden.sales_raw().withColumn("ReturnFlag", F.lit(0)).select(S.SALES_EXTRACT.fieldNames())
    extracts.write_extract(flags, f"{folder}/sales_20260303.csv")
    extracts.write_extract(golden.customers.select(S.CUSTOMER_EXTRACT.fieldNames()), f"{folder}/customers.csv")
    stock = golden.spark.createDataFrame([("PRD004", "STR003", 0, 10), ("PRD002", "STR001", 10, 10)],
                                         S.INVENTORY_EXTRACT)
    extracts.write_extract(stock, f"{folder}/inventory.csv")
    return str(folder)


def test_a_day_can_be_run_twice(spark, golden, golden_warehouse, landing, tmp_path, monkeypatch):
    from tillspark.plans import churn_model

    train = churn_model.train
    monkeypatch.setattr(churn_model, "train", lambda rows, exclude=None: train(rows, exclude, trees=3))
    golden_warehouse.replace("DimCustomer", golden.customers.filter("CustomerKey <= 6"))

    def run():
        report = daily.run_day(
            golden_warehouse,
            landing,
            AS_OF,
            batch_id="20260303",
            model_path=str(tmp_path / "model"),
            write_texts=lambda prompts: prompts.selectExpr("InsightArea", "concat('About ', InsightArea) AS InsightText"),
            model_version="m1",
        )
        return {r.TableName: r.TableRows for r in report.collect()}

    expected = {
        "SalesRaw": 11, "CustomerRaw": 8, "InventoryRaw": 2, "DimCustomer": 8, "FactSales": 11, "SalesRejects": 0,
        "FactCustomerActivity": 8, "ChurnScores": 8, "FactInventory": 2, "AIInsights": 4,
        "ModelEvaluation": 0, "ModelImportance": len(churn_model.MODEL_FEATURES), "ScoreProfile": 1, "ScorePreview": 8,
    }
    assert run() == expected
    assert run() == expected
    assert golden_warehouse.read("DimCustomer").filter(F.col("LastScoredDate") == F.lit(AS_OF)).count() == 8

    views.register(golden_warehouse, AS_OF)
    march = spark.table("vw_SalesSummary").filter((F.col("Year") == 2026) & (F.col("MonthNumber") == 3))
    per_group = march.groupBy("Category", "SubCategory").agg(F.sum("NetSales").alias("NetSales"))
    top = sorted(per_group.collect(), key=lambda r: -r.NetSales)[:5]
    assert [(r.SubCategory, r.NetSales) for r in top] == [
        ("Smart Home", Decimal("199.99")), ("Kitchen", Decimal("151.981")), ("Kitchen", Decimal("59.98"))
    ]
    assert spark.sql("SELECT * FROM vw_KPISummary").first().TotalRevenue == Decimal("411.951")
    assert spark.sql("SELECT * FROM vw_InventoryIntelligence").count() == 2
    assert spark.sql("SELECT * FROM vw_ChurnRiskDashboard").count() == 8


def test_an_area_that_fails_leaves_the_others(golden_warehouse, golden):
    golden_warehouse.put_batch("FactSales", golden.fact, "first")

    def write_texts(prompts):
        if prompts.first().InsightArea == "Churn":
            raise RuntimeError("no answer")
        return prompts.selectExpr("InsightArea", "'text' AS InsightText")

    assert daily.refresh_insights(golden_warehouse, AS_OF, "b", write_texts) == ["Churn"]
    assert sorted(r.InsightArea for r in golden_warehouse.read("AIInsights").collect()) == ["Inventory", "Overall", "Revenue"]


def test_corrupt_lines_stop_the_day(golden_warehouse, landing, tmp_path):
    write_sales(tmp_path / "landing", "sales_bad.csv", "A,1,CUST001,PRD001,STR001,2026-03-03,many,10.00,0,0")
    with pytest.raises(extracts.CorruptExtractError, match="1 lines"):
        daily.copy_extracts(golden_warehouse, landing)
    daily.copy_extracts(golden_warehouse, landing, keep_corrupt=True)
    staged = golden_warehouse.read("SalesRaw")
    assert (staged.count(), staged.filter("Quantity IS NULL").count()) == (12, 1)
    assert golden_warehouse.read("CustomerRaw").count() == 8


def test_a_second_delivery_adds_its_lines(golden, golden_warehouse, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    line = "{},1,CUST001,PRD001,STR001,2026-03-03,{},10.00,0,0".format
    write_sales(first, "sales_1.csv", line("A", 1))
    write_sales(second, "sales_1.csv", line("A", 1), line("B", 1))
    for folder in (first, second):
        raw = extracts.read_extract(golden.spark, str(folder), extracts.SALES_FILES, S.SALES_EXTRACT)
        golden_warehouse.replace("SalesRaw", extracts.as_sales_raw(raw))
        daily.refresh_sales(golden_warehouse, AS_OF, batch_id=folder.name)
    assert sorted(r.OrderID for r in golden_warehouse.read("FactSales").collect()) == ["A", "B"]
    staged = golden_warehouse.read("SalesRaw").collect()
    assert {(r.ProcessedFlag, r.ProcessedDate) for r in staged} == {(True, dt.datetime(2026, 3, 3))}


def test_shuffles_grow_with_the_input_only(spark):
    from tillspark.session import size_shuffles

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for size, expected in ((1, before), (100 << 30, "800"), (1 << 30, "800"), (1 << 50, str(1 << 23))):
            size_shuffles(spark, size)
            assert spark.conf.get(key) == expected
    finally:
        spark.conf.set(key, before)
