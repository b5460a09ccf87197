"""A narrow table of the keys of a batch table, so that a load need not scan the table itself.

Every published batch has its keys in a table of their own, with files bucketed
and sorted by key, and a Bloom filter per bucket.  There are two exact ways to
find which keys of new rows are there already:

* A small set of rows is tested against the filters first.  Only bucket files
  whose filter may hold one of its keys are opened, and their keys are compared.
* A large set is joined to the whole key table, which is bucketed by the join
  keys: only the new rows are shuffled.

A filter is cut into blocks of 4 KB; all bits of a key are in one block.  So a
key meets one row per batch, and filters of any size are made by aggregation.
"""

from __future__ import annotations

import hashlib
import re
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tillspark.operators.joins import if_small
from tillspark.session import shuffles_go

if TYPE_CHECKING:
    from tillspark.sources.warehouse import Warehouse

#: Files per batch, bits of a filter's block, bits of a filter per key, and bits that a key sets.
BUCKETS, BLOCK_BITS, BITS_PER_KEY, BITS_SET = 32, 32768, 16, 4

_BUCKET_FILE = re.compile(r"_(\d+)(?:\.[^/]*)?$")
_LEVELS = 24


def _bucket(keys: list[str], buckets: int) -> Column:
    """The bucket that Spark's writer puts a row into."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _block(keys: list[str], blocks: Column) -> Column:
    """A key's block among a power of two of them."""
    return F.xxhash64(F.lit(0), *keys).bitwiseAND(blocks.cast("long") - 1).cast("int")


def _bits(keys: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK_BITS)) for i in range(1, BITS_SET + 1)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1


class KeyIndex:
    """Keys and filters of one batch table of a warehouse."""

    def __init__(self, warehouse: Warehouse, name: str, schema: StructType, keys: list[str], buckets: int = BUCKETS):
        from tillspark.sources.warehouse import ATTEMPT, BATCH

        self.warehouse, self.spark, self.name, self.keys, self.buckets = warehouse, warehouse.spark, name, keys, buckets
        self.batch, self.attempt = BATCH, ATTEMPT
        self.root = f"{warehouse.root}/{name}Keys"
        types = {f.name: f.dataType.simpleString() for f in schema}
        self.columns = ", ".join(f"{k} {types[k]}" for k in keys)
        self.filter_schema = (
            StructType().add("KeyBucket", IntegerType()).add("Blocks", IntegerType()).add("Block", IntegerType()).add("Bits", "binary").add("Keys", LongType())
        )
        self.table_name = f"keys_{hashlib.sha1(self.root.encode()).hexdigest()[:16]}"

    # --- writing ------------------------------------------------------------
    def write(self, rows: DataFrame, batch_id: str, attempt: int) -> None:
        """Store keys and filters of one attempt of a batch; they count once the batch is published.

        Files that an attempt which broke off has left are replaced.
        """
        self._declare()
        # As many tasks as buckets, dealt like the buckets: each writes one sorted file.  Equal keys meet there, without a shuffle of their own.
        dealt = rows.select(*self.keys).repartition(self.buckets, *self.keys).distinct().sortWithinPartitions(*self.keys)
        # A statement that names the partition: any other batch's files stay.
        name = batch_id.replace("\\", "\\\\").replace("'", "\\'")
        with shuffles_go(self.spark):
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.table_name} PARTITION ({self.batch} = '{name}', {self.attempt} = {attempt}) SELECT * FROM {{dealt}}", dealt=dealt
            )
        self.spark.catalog.refreshTable(self.table_name)

        written = self.spark.table(self.table_name).filter((F.col(self.batch) == batch_id) & (F.col(self.attempt) == attempt)).select(*self.keys)
        counted = written.withColumn("KeyBucket", _bucket(self.keys, self.buckets))
        sizes = counted.groupBy("KeyBucket").agg(F.count(F.lit(1)).alias("Keys"))
        blocks = F.pow(F.lit(2), F.least(F.lit(_LEVELS), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("Keys") * BITS_PER_KEY / BLOCK_BITS))))).cast("int")
        sized = counted.join(F.broadcast(sizes.withColumn("Blocks", blocks)), "KeyBucket")  # one row per bucket
        marks = sized.select("KeyBucket", "Blocks", "Keys", _block(self.keys, F.col("Blocks")).alias("Block"), F.explode(F.array(*_bits(self.keys))).alias("Bit"))
        filters = marks.groupBy("KeyBucket", "Blocks", "Block").agg(F.bitmap_construct_agg("Bit").alias("Bits"), F.first("Keys").alias("Keys"))
        # A batch without keys has a row too, to show that it is indexed.
        mark = self.spark.range(1).select(F.lit(-1).alias("KeyBucket"), F.lit(1).alias("Blocks"), F.lit(0).alias("Block"), F.lit(b"").alias("Bits"), F.lit(0).alias("Keys"))
        filters = filters.select(*mark.columns).unionByName(mark)
        shaped = filters.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.filter_schema], F.lit(batch_id).alias(self.batch), F.lit(attempt).alias(self.attempt))
        writer = shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with shuffles_go(self.spark):
            writer.partitionBy(self.batch, self.attempt).parquet(f"{self.root}/filters")

    def complete(self) -> None:
        """Index what was published before there was an index."""
        published = self.warehouse._published(self.name)
        have = self._all_filters().select(self.batch, self.attempt).distinct()
        for row in published.join(have, [self.batch, self.attempt], "left_anti").collect():
            self.write(self.warehouse.attempt_rows(self.name, row[0], row[1]), row[0], row[1])

    # --- reading ------------------------------------------------------------
    def seen(self, rows: DataFrame, but: str | None = None) -> DataFrame:
        """Different keys of published batches, all those among them that ``rows`` have; ``but`` names a batch that is left out."""
        published = self.warehouse._published(self.name)
        if but is not None:
            published = published.filter(F.col(self.batch) != but)
        if published.isEmpty():
            # Known to the optimizer to be none: the new rows need not be dealt out to be compared.
            return self.warehouse._empty(self._keys(published).schema)
        wanted = rows.select(*self.keys).distinct()
        small = if_small(wanted)
        if small is wanted:
            return self._keys(published)
        files = self.files(self._may_hold(wanted, published))
        if not files:
            return self.warehouse._empty(self._keys(published).schema)
        return self.spark.read.schema(self.columns).parquet(*files)

    def files(self, buckets: DataFrame) -> list[str]:
        """Files of buckets given as batch, attempt and KeyBucket: one name each, which the driver holds as for any scan."""
        chosen = {tuple(r) for r in buckets.select(self.batch, self.attempt, "KeyBucket").collect()}
        return [unquote(f) for f in self._all_files() if self._place(f) in chosen]

    def _place(self, file: str) -> tuple[str, int, int]:
        # Folder names are escaped by the writer, and again as a location.
        parts = dict(unquote(unquote(p)).split("=", 1) for p in file.split("/") if "=" in p)
        return parts[self.batch], int(parts[self.attempt]), int(_BUCKET_FILE.search(file).group(1))

    def _all_files(self) -> list[str]:
        self._declare()
        return list(self.spark.table(self.table_name).inputFiles())

    def _keys(self, published: DataFrame) -> DataFrame:
        self._declare()
        rows = self.spark.table(self.table_name)
        return rows.join(if_small(published), [self.batch, self.attempt], "left_semi").select(*self.keys)

    def _all_filters(self) -> DataFrame:
        schema = StructType([*self.filter_schema.fields, *StructType().add(self.batch, "string").add(self.attempt, "integer").fields])
        return self.warehouse._scan(f"{self.root}/filters", schema)

    def _may_hold(self, wanted: DataFrame, published: DataFrame) -> DataFrame:
        """Buckets of published batches whose filter holds a key: never one too few."""
        filters = self._all_filters().join(if_small(published), [self.batch, self.attempt], "left_semi")
        levels = [r[0] for r in filters.select("Blocks").distinct().collect()]  # powers of two, so a few
        asked = wanted.withColumn("KeyBucket", _bucket(self.keys, self.buckets)).withColumn("Blocks", F.explode(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>")))
        asked = asked.select("KeyBucket", "Blocks", _block(self.keys, F.col("Blocks")).alias("Block"), F.array(*_bits(self.keys)).alias("Places"))
        held = asked.join(filters, ["KeyBucket", "Blocks", "Block"])
        for i in range(BITS_SET):
            held = held.filter(_is_set(F.col("Bits"), F.get("Places", F.lit(i))))
        return held.select(self.batch, self.attempt, "KeyBucket").distinct()

    def _declare(self) -> None:
        """Make the key table known to the session; its files stay where they are."""
        keys = ", ".join(self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table_name} ({self.columns}, {self.batch} STRING, {self.attempt} INT) USING parquet"
            f" PARTITIONED BY ({self.batch}, {self.attempt}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.root}/data'"
        )
        self.spark.catalog.refreshTable(self.table_name)
