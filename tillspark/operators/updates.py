"""Table updates expressed as new table contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.operators.joins import lookup
from tillspark.operators.ranking import numbered


class DuplicateKeyError(ValueError):
    """A table that must have one row per key has more."""


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when a key occurs twice."""
    twice = df.groupBy(*keys).count().filter("count > 1").select(*keys).limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"{keys} is not unique, for example {twice[0].asDict()}")


def update_matched(
    target: DataFrame, changes: DataFrame, on: str, assignments: dict[str, Column]
) -> DataFrame:
    """Set columns of the rows that have a match in ``changes``; leave all others as they are.

    ``changes`` has one row per key.  Assignments refer to its columns.
    """
    matched = F.col("__matched").isNotNull()
    joined = lookup(target, changes.withColumn("__matched", F.lit(True)), on, "left")
    return joined.select(
        *[
            F.when(matched, assignments[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in assignments
            else F.col(c)
            for c in target.columns
        ]
    )


def upsert_type1(
    dim: DataFrame, incoming: DataFrame, business_key: str, surrogate_key: str, defaults: dict[str, Column]
) -> DataFrame:
    """Overwrite attributes of known members and add new ones under fresh surrogate keys.

    Several incoming rows for one member collapse to the largest one, so that a
    re-run gives the same result.  Columns that ``incoming`` lacks keep their
    value, or get ``defaults`` (else NULL) in new members.
    """
    attributes = [c for c in incoming.columns if c in dim.columns and c != business_key]
    latest = (
        incoming.filter(F.col(business_key).isNotNull())
        .groupBy(business_key)
        .agg(F.max(F.struct(*attributes)).alias("__new"))
    )
    known = update_matched(dim, latest, business_key, {c: F.col("__new")[c] for c in attributes})
    fresh = numbered(latest.join(dim.select(business_key), business_key, "left_anti"), [business_key])
    highest = dim.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()

    def value(c: str) -> Column:
        if c == surrogate_key:
            return F.col("RowNumber") + highest
        if c == business_key:
            return F.col(c)
        if c in attributes:
            return F.col("__new")[c]
        return defaults.get(c, F.lit(None))

    added = fresh.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in dim.schema])
    return known.unionByName(added)
