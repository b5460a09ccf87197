"""Row-level security by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.fixed_values import UNRESTRICTED_ROLES
from tillspark.operators.joins import lookup


def visible_to(df: DataFrame, user_regions: DataFrame, principal: str, role: str = "RegionManagers") -> DataFrame:
    """Rows of the regions that ``principal`` is mapped to; executives see everything.

    ``df`` has a ``Region``.  Restrict the store dimension, and every report
    that joins it shows the principal's regions only.
    """
    if role in UNRESTRICTED_ROLES:
        return df
    regions = user_regions.filter(F.col("UserEmail") == principal).select("Region")
    return lookup(df, regions, "Region", "left_semi")
