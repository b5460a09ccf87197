"""Short stand-ins for wide grouping columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.operators.joins import if_small


def group_codes(dim: DataFrame, key: str, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Replace descriptive columns by one code: the smallest dimension key that has the same values.

    Returns ``key -> code`` and ``code -> columns``.  A fact grouped by the code
    shuffles one long instead of several strings, and gets the strings back
    once per group.  NULLs form a group of their own, as in any grouping.
    """
    codes = dim.groupBy(*columns).agg(F.min(key).alias(name))
    left, right = dim.select(key, *columns).alias("l"), if_small(codes).alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in columns]
    return left.join(right, same).select(F.col(f"l.{key}"), F.col(f"r.{name}")), codes
