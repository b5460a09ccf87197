"""Delimited extracts with a header line."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillspark.session import shuffles_go

CORRUPT = "_corrupt_record"
SALES_FILES = "sales_*.csv"
CUSTOMER_FILES = "customers*.csv"
INVENTORY_FILES = "inventory*.csv"


class CorruptExtractError(ValueError):
    """An extract has lines that do not fit its schema."""


class MissingColumnError(ValueError):
    """An extract lacks a column."""


def with_corrupt_column(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def files_of(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Files of one folder whose name fits ``pattern``; subfolders are not searched."""
    found = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{pattern}").select("path")
    return sorted(r["path"] for r in found.collect())


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a file's first line, as its reader will see them."""
    return tuple(spark.read.option("header", True).csv(file).columns)


def _plain(path: str) -> str:
    return path.replace("file:///", "file:/")


def files_by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names and the files that have them.

    One job finds the first line of every file, in the tasks that read it, and
    another job per different first line has it taken apart by the reader.  So
    the number of jobs is that of different headers, not of files.  Files
    without a line have no columns.
    """
    if not files:
        return {}
    # A file's first lines are read by one task, in order, whatever else that task reads.
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    lines = spark.read.text(files).select("value", *place, F.monotonically_increasing_id().alias("number"))
    first = lines.filter((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "number").alias("line"))
    by_line = first.groupBy("line").agg(F.collect_list("file").alias("files")).collect()
    named = {_plain(f): f for f in files}
    out: dict[tuple[str, ...], list[str]] = {}
    for row in by_line:
        own = sorted(named.pop(_plain(unquote(f))) for f in row["files"])
        out.setdefault(_header(spark, own[0]), []).extend(own)
    if named:
        out.setdefault((), []).extend(named.values())
    return {header: sorted(own) for header, own in sorted(out.items())}


def read_files(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    """Extract files, with columns found by their names in each file's header.

    Files with the same header are read together.  Columns that the schema
    lacks are left out; a column that a file lacks is an error.  A line that
    does not fit the schema has NULL in the offending columns and its text in
    ``_corrupt_record``.
    """
    parts = []
    for header, group in files_by_header(spark, files).items():
        if missing := [f.name for f in schema if f.name not in header]:
            raise MissingColumnError(f"{', '.join(missing)} not in the header of {group[0]}")
        known = {f.name: f for f in schema}
        own = StructType([known.get(name, StructField(name, StringType())) for name in header])
        lines = (
            spark.read.schema(with_corrupt_column(own))
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(group)
        )
        parts.append(lines.select(*schema.names, CORRUPT))
    if not parts:
        return spark.createDataFrame([], with_corrupt_column(schema))
    return reduce(DataFrame.unionByName, parts)


def read_extract(spark: SparkSession, folder: str, pattern: str, schema: StructType) -> DataFrame:
    """All extract files of a folder; none at all is an error."""
    files = files_of(spark, folder, pattern)
    if not files:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return read_files(spark, files, schema)


def count_corrupt(lines: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """Count corrupt lines on the way: the count can be asked once the returned frame has been written."""
    seen = Observation()
    observed = lines.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
    return observed, lambda: seen.get["corrupt"]


def stream_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Names of arriving files as a stream that picks up each file once; their content is not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.load(f"{folder.rstrip('/')}/{pattern}").select("path")


def write_extract(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write ``df`` as delimited text with a header, replacing what was there.

    Readers of extracts take plain and compressed files alike; a compressed file is read by one task.
    """
    writer = df.write.mode("overwrite").option("header", True).option("compression", compression)
    with shuffles_go(df.sparkSession):
        # Speed before size: the level counts for gzip only.
        writer.option("zlib.compress.level", "BEST_SPEED").csv(path)


def as_sales_raw(extract: DataFrame) -> DataFrame:
    """Sales staging rows: flags become booleans, rows start unprocessed."""
    return extract.select(
        "OrderID",
        "OrderLineID",
        "CustomerID",
        "ProductID",
        "StoreID",
        "OrderDate",
        "Quantity",
        "UnitPrice",
        "Discount",
        F.col("ReturnFlag").cast("boolean").alias("ReturnFlag"),
        F.lit(False).alias("ProcessedFlag"),
        F.lit(None).cast("timestamp").alias("ProcessedDate"),
    )
