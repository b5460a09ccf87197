"""Written intermediate tables and names that clash with nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tillspark.session import SHUFFLES_GO, shuffles_go, work_dir  # noqa: F401


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for a table in the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared work folder and read it back: its plan starts anew, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", compression) if compression else df.write
    with shuffles_go(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
