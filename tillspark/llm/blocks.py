"""Documents in blocks of bounded size that several passes read without shuffling texts.

Passes over blocks ask about hashes: each block sends what it asks to the task
that is responsible for a range of hashes, which answers every block by itself.
Requests and answers are sorted numbers, compressed.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.tables import new_folder

#: Documents per block, the unit that a task holds in memory.
BLOCK_ROWS = 4096


def block_number(rows: int = BLOCK_ROWS) -> Column:
    """A number for every run of ``rows`` rows that a task reads one after the other."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.spark_partition_id().cast("long") * (1 << 33) + F.floor(within / rows)


def in_blocks(docs: DataFrame, columns: list[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """A stored copy of ``columns`` with ``block``, bucketed by it.

    The copy is written where the rows are read, without a shuffle; grouping it
    by block, or grouping it together with answers to its blocks, moves no text.
    """
    spark = docs.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(most, max(1, 2 * math.ceil(docs.count() / rows)))
    name = f"blocks_{uuid.uuid4().hex[:12]}"
    numbered = docs.select(*columns).withColumn("block", block_number(rows))
    writer = numbered.write.bucketBy(buckets, "block").option("compression", "zstd")
    writer.option("path", new_folder(spark, name)).format("parquet").saveAsTable(name)
    return spark.table(name)


def packed(numbers: np.ndarray) -> bytes:
    """Compress numbers that mostly rise: differences, byte planes apart."""
    width = numbers.dtype.itemsize
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    steps = np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()
    return np.cumsum(steps, dtype=dtype)
