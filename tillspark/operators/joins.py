"""Joins that choose their strategy from the size of their inputs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when broadcasting is off."""
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


# Rows in memory take several times the bytes of their compressed files.
MEMORY_PER_FILE_BYTE = 4
#: Rows of two or three numbers or short texts that are broadcast; a million take some 60 to 100 MB.
FEW_ROWS = 1_000_000


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of all relations a plan reads.

    Bounds the size of a table that is built by filters and many-to-one lookups
    only.  Spark multiplies the sizes of joined inputs, so a dimension put
    together from three small files would look too large to broadcast.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def if_small(dim: DataFrame) -> DataFrame:
    """Broadcast hint when everything ``dim`` reads fits the session's threshold in memory, else no hint.

    Without the hint the join shuffles, and the adaptive planner splits hot keys.
    """
    limit = broadcast_limit(dim.sparkSession)
    return F.broadcast(dim) if 0 <= MEMORY_PER_FILE_BYTE * scanned_bytes(dim) <= limit else dim


def if_few(dim: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Broadcast hint for a few narrow columns of up to ``FEW_ROWS`` rows, beyond what :func:`if_small` allows.

    Files of wide rows look too large to broadcast though two or three of their
    columns are not, and without the hint every row of a fact is shuffled to
    meet them.  The rows are counted, from file footers where nothing is
    filtered; ``counted`` is a cheaper frame with as many rows or more.  Where
    broadcasting is off it stays off.
    """
    hinted = if_small(dim)
    if hinted is not dim or broadcast_limit(dim.sparkSession) <= 0:
        return hinted
    return F.broadcast(dim) if (dim if counted is None else counted).count() <= FEW_ROWS else dim


def lookup(left: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Many-to-one join to a dimension with unique keys."""
    return left.join(if_small(dim), on, how)


def occurring(rows: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of ``present``, which may be the whole history, reduced to those that ``rows`` may have.

    When the new rows are small their keys are broadcast, so that the history is
    scanned for the key columns but not shuffled.
    """
    known, wanted = present.select(*keys), rows.select(*keys)
    reduced = if_small(wanted)
    return known if reduced is wanted else known.join(reduced, keys, "left_semi")


def not_in(rows: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys do not occur in ``present``; a NULL key never matches."""
    return rows.join(occurring(rows, present, keys), keys, "left_anti")
