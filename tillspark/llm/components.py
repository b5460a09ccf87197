"""Connected components by alternating large and small stars, for edges of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on the smallest of them: the larger ones, or the smaller ones and the node itself."""
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(swapped) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = around.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id it is linked to, for every node of edges (a, b) but the smallest themselves.

    Nodes are hung on smaller ones until nothing changes, in a number of rounds
    that grows with the logarithm of the longest path; every round is written.
    """
    edges, before = stored(edges.filter("a != b").distinct(), "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("component"))
        before = state
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
