"""Exact numbering, quantiles and top rows without a task that holds a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 8
_BUCKET, _HASH, _OFFSET = "__bucket", "__hash", "__offset"


def numbered(
    df: DataFrame,
    unique_key: list[str],
    by: list[str] | None = None,
    name: str = "RowNumber",
    seed: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows of each ``by`` group 1..n in a pseudo-random but repeatable order.

    A plain ``row_number`` needs all rows of a group in one task.  Here rows are
    spread over hash buckets and numbered within them; the start of each bucket
    comes from a table of at most ``groups x buckets`` counts.  ``unique_key``
    must identify a row, so that a re-run numbers alike.  There are several
    buckets per shuffle partition, whose number follows the input.
    """
    by = by or []
    buckets = buckets or BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.withColumn(_HASH, F.xxhash64(*unique_key, F.lit(seed))).withColumn(
        _BUCKET, F.pmod(_HASH, F.lit(buckets))
    )
    before = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*by, _BUCKET)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*by, _BUCKET, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(_OFFSET))
    )
    within = Window.partitionBy(*by, _BUCKET).orderBy(_HASH, *unique_key)
    # Groups may be NULL, so the keys are compared null-safely.
    keys = [*by, _BUCKET]
    offsets = offsets.select(*[F.col(c).alias(f"__offset_{i}") for i, c in enumerate(keys)], _OFFSET)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__offset_{i}")) for i, c in enumerate(keys)])
    ranked = hashed.withColumn(name, F.row_number().over(within)).join(offsets, same)
    return ranked.select(*df.columns, (F.col(name) + F.col(_OFFSET)).cast("long").alias(name))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


def _size_class(x: Column) -> Column:
    """A number that never falls as ``x`` rises: about a thousandth of its size apart, whatever the size."""
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * 1024).cast("long")


def quantiles(df: DataFrame, columns: list[str], q: float) -> dict[str, Column]:
    """Exact, linearly interpolated ``q``-quantile of each column, as expressions.

    Equal values are counted by a shuffle and the counts added up per class of
    size, of which there are some ten thousand; only the classes that hold the
    two ranks are then ordered by value.  All of it is part of the plan, as a
    scalar subquery: nothing runs before the plan does.  NULLs do not count; a
    column without values has the quantile NULL.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.name", "p.x").filter("x IS NOT NULL").groupBy("name", "x")
    counts = counts.agg(F.count(F.lit(1)).alias("n")).withColumn("size", _size_class(F.col("x")))

    def earlier(*keys: str) -> Window:
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    sizes = counts.groupBy("name", "size").agg(F.sum("n").alias("rows"))
    position = (F.sum("rows").over(Window.partitionBy("name")) - 1) * F.lit(q)
    sizes = sizes.withColumn("position", position).withColumn("before", F.coalesce(F.sum("rows").over(earlier("name", "size")), F.lit(0)))
    low, high = F.floor("position"), F.ceil("position")
    holds = (F.col("before") <= high) & (F.col("before") + F.col("rows") > low)
    near = counts.join(sizes.filter(holds).select("name", "size", "position", "before"), ["name", "size"])
    first = F.col("before") + F.coalesce(F.sum("n").over(earlier("name", "size", "x")), F.lit(0))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (F.col("first") + F.col("n") > rank), F.col("x")))

    values = near.withColumn("first", first).groupBy("name").agg(at(low).alias("low"), at(high).alias("high"), F.max("position").alias("position"))
    found = values.withColumn("q", F.col("low") + (F.col("high") - F.col("low")) * (F.col("position") - F.floor("position")))
    one = found.agg(F.struct(*[F.max(F.when(F.col("name") == c, F.col("q"))).alias(c) for c in columns]).alias("q")).scalar()
    return {c: one.getField(c) for c in columns}
