"""Measures under several filter contexts, and headers of many files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillspark.plans import measures
from tillspark.sources import extracts

SCHEMA = "a string, b string, NetSales decimal(12,2), GrossProfit decimal(12,2), OrderCount long"


@pytest.fixture(scope="module")
def summary(spark):
    rows = [("x", "p", 10, 1, 1), ("x", "q", 20, 5, 1), ("x", None, 30, 5, 2), ("y", "p", 0, 0, 3), (None, "p", 7, 7, 1), (None, None, 1, 0, 1)]
    return spark.createDataFrame(rows, "a string, b string, n long, g long, OrderCount long").select(
        "a", "b", F.col("n").cast("decimal(12,2)").alias("NetSales"), F.col("g").cast("decimal(12,2)").alias("GrossProfit"), "OrderCount"
    )


def test_contexts_equal_separate_calls(summary):
    report = measures.sales_report(summary, [["a", "b"], ["a"], ["b"], []])
    for context, by in ((0, ["a", "b"]), (1, ["a"]), (2, ["b"]), (3, [])):
        rows = report.filter(F.col("Context") == context)
        alone = measures.sales_measures(summary, by or None)
        assert sorted(map(tuple, rows.select(*alone.columns).collect()), key=str) == sorted(map(tuple, alone.collect()), key=str)
    assert report.filter("Context = 1 and a is null").count() == 1
    assert report.filter("Context = 3 and a is null").count() == 1


def test_all_contexts_are_one_scan(spark, summary, tmp_path):
    summary.write.parquet(str(tmp_path / "summary"))
    stored = spark.read.parquet(str(tmp_path / "summary"))
    plan = measures.sales_report(stored, measures.levels(["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_levels_and_the_total_alone(summary):
    assert measures.levels(["a", "b"]) == [["a", "b"], ["a"], []]
    total = measures.sales_report(summary, [[]]).collect()
    assert len(total) == 1 and total[0]["Context"] == 0 and total[0]["TotalNetSales"] == 68


def test_headers_of_many_files_take_few_jobs(spark, tmp_path):
    names = [tmp_path / f"in {i:03d}%.csv" for i in range(60)]
    for i, file in enumerate(names):
        file.write_text('a,"b c"\n1,2\n' if i % 2 else '\n"b c",a,more\n2,1,x\n')
    (tmp_path / "in empty.csv").write_text("")
    files = extracts.files_of(spark, str(tmp_path), "in*.csv")
    assert len(files) == 60  # files of no bytes are not listed
    files.append(f"file:{tmp_path}/in empty.csv")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = extracts.files_by_header(spark, files)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in found.items()} == {("a", "b c"): 30, ("b c", "a", "more"): 30, (): 1}
    assert jobs <= 8
    rows = extracts.read_files(spark, [f for h, own in found.items() if h for f in own], extracts.StructType().add("a", "integer").add("b c", "integer"))
    assert rows.groupBy("a", "b c").count().collect() == [(1, 2, 60)]
    with pytest.raises(extracts.MissingColumnError):
        extracts.read_files(spark, files, extracts.StructType().add("a", "integer"))
