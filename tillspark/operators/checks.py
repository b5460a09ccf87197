"""Data-quality checks: orphans, duplicate keys, missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.operators.joins import lookup


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphans(fact: DataFrame, dims: dict[str, DataFrame], foreign_keys: dict[str, str]) -> DataFrame:
    """Rows and distinct values per foreign key that miss in the dimension; NULL keys are not orphans.

    The fact is counted per key value before the join, so a hot key is one row
    by then and only key values are shuffled.
    """

    def check(key: str, dim_name: str) -> DataFrame:
        uses = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("uses"))
        missing = lookup(uses, dims[dim_name].select(key), key, "left_anti")
        return missing.agg(
            F.count(F.lit(1)).alias("OrphanKeys"), F.coalesce(F.sum("uses"), F.lit(0)).alias("OrphanRows")
        ).select(F.lit(key).alias("ForeignKey"), F.lit(dim_name).alias("Dimension"), "OrphanKeys", "OrphanRows")

    return _union([check(key, dim) for key, dim in foreign_keys.items()])


def duplicate_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Key values that occur more than once."""

    def check(name: str) -> DataFrame:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in keys[name]])
        return (
            tables[name]
            .groupBy(*keys[name])
            .agg(F.count(F.lit(1)).alias("Copies"))
            .filter(F.col("Copies") > 1)
            .select(F.lit(name).alias("TableName"), text.alias("KeyValue"), "Copies")
        )

    return _union([check(name) for name in tables])


def missing_values(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """NULLs per required column, one pass per table."""

    def check(name: str) -> DataFrame:
        columns = required[name]
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return counts.unpivot([], columns, "ColumnName", "Missing").select(
            F.lit(name).alias("TableName"), "ColumnName", "Missing"
        )

    return _union([check(name) for name in tables])
