"""Work that must not grow with the number of parts, or be repeated."""

import datetime as dt

from pyspark.sql import functions as F

from tillspark.plans import churn_model
from tillspark.sources import sample_tables
from tillspark.sources.sample_tables import SampleTables


def test_a_large_training_set_is_merged_into_parts_for_the_cores(spark, monkeypatch):
    rows = spark.range(0, 200, 1, 50)
    assert churn_model.in_training_parts(rows).rdd.getNumPartitions() == 50
    monkeypatch.setattr(churn_model, "MERGED_FROM", 100)
    merged = churn_model.in_training_parts(rows)
    assert merged.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in merged.collect()) == list(range(200))
    monkeypatch.setattr(churn_model, "ROWS_PER_PART", 20)
    assert churn_model.in_training_parts(rows).rdd.getNumPartitions() == 10


def test_days_that_tasks_do_not_mix_are_written_without_a_shuffle(spark, warehouse):
    def snapshot(n: int):
        day = F.when(F.col("id") < 40, 20260301).otherwise(20260302)
        texts = [F.lit("Low").alias("StockOutRisk"), F.lit(False).alias("OverstockFlag")]
        numbers = [F.lit(n).alias(c) for c in ("StoreKey", "QuantityOnHand", "ReorderPoint", "DaysOfSupply")]
        return spark.range(0, 80, 1, 4).select(day.alias("DateKey"), F.col("id").alias("ProductKey"), *numbers, *texts)

    warehouse.put_snapshot("FactInventory", snapshot(1), by_day=True)
    warehouse.put_snapshot("FactInventory", snapshot(2).filter("id >= 40"), by_day=True)
    stored = warehouse.read("FactInventory")
    assert {(r.DateKey, r.QuantityOnHand, r["count"]) for r in stored.groupBy("DateKey", "QuantityOnHand").count().collect()} == {
        (20260301, 1, 40), (20260302, 2, 40),
    }
    # A file for each task that has rows of the day: nothing gathered them.
    assert stored.filter("DateKey = 20260301").select(F.input_file_name()).distinct().count() == 2


def _little_shop(spark, folder):
    days = [dt.datetime(2001, 7, 1), dt.datetime(2001, 7, 20), dt.datetime(1995, 1, 1), None]
    orders = [(i, 1, "O", 1.0, days[i % 4], "1") for i in range(8)]
    lines = [(i % 9, 1 + i % 2, 1, i, 2.0, 3.0, 0.05, 0.0, "N", "O", days[0]) for i in range(36)]
    parts = [(k, "p", "b", "t", 1, 10.0 * k) for k in (1, 2)]
    for name, rows in (("orders", orders), ("lineitem", lines), ("part", parts)):
        spark.createDataFrame(rows, sample_tables.COLUMNS[name]).write.parquet(f"{folder}/{name}.parquet")
    return SampleTables(spark, str(folder))


def test_few_orders_of_a_period_are_broadcast_to_the_lines(spark, tmp_path, monkeypatch):
    shop = _little_shop(spark, tmp_path)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def lines():
            return shop.order_lines(since=dt.date(2001, 7, 10))

        def hints(df):
            return str(df._jdf.queryExecution().optimizedPlan().toString()).count("strategy=broadcast")

        few = lines()
        monkeypatch.setattr(sample_tables, "FEW_ORDERS", 1)
        many = lines()
        assert (hints(few), hints(many)) == (1, 0)
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
        assert {r.l_orderkey for r in few.collect()} == {1, 5}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
