"""Exact distinct counts of numbers that add up: bitmaps of 32768 numbers each, merged by OR."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number_bitmaps(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """The different numbers of each group as rows ``by``, Bucket, Bits; NULLs are no numbers.

    A row of ``df`` sets one bit before the shuffle, so a hot group moves its bitmaps and not its rows.
    """
    known = df.filter(F.col(number).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("Bits")
    return known.groupBy(*by, F.bitmap_bucket_number(number).alias("Bucket")).agg(bits)


def count_numbers(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """Different numbers of each group of bitmaps, whatever groups they were made for."""
    merged = bitmaps.groupBy(*by, "Bucket").agg(F.bitmap_or_agg("Bits").alias("Bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("Bits")).alias(name))
