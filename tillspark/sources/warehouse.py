"""Parquet tables under one root folder.

Three ways of writing cover the engine:

* ``replace`` writes a whole new version and then publishes its number, so a
  plan may read the version it replaces and readers never see half a table;
* ``put_batches`` writes one batch of several tables and publishes it as a whole:
  a replay of the batch takes the place of what was published before;
* ``put_snapshot`` replaces the partitions of the dates it contains.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillspark import schemas as S
from tillspark.functions.dates import month_of_key
from tillspark.functions.money import unit_margin_percent
from tillspark.operators.joins import if_small
from tillspark.operators.updates import require_unique
from tillspark.session import shuffles_go
from tillspark.sources.key_index import KeyIndex

BATCH, ATTEMPT, MONTH = "BatchID", "Attempt", "SaleMonth"

TABLES: dict[str, StructType] = {
    "SalesRaw": S.SALES_RAW,
    "CustomerRaw": S.CUSTOMER_EXTRACT,
    "InventoryRaw": S.INVENTORY_EXTRACT,
    "SupportTickets": S.SUPPORT_TICKETS,
    "ChurnScores": S.CHURN_SCORES,
    "Targets": S.TARGETS,
    "UserRegions": S.USER_REGIONS,
    "DimDate": S.DIM_DATE,
    "DimStore": S.DIM_STORE,
    "DimProduct": S.DIM_PRODUCT,
    "DimCustomer": S.DIM_CUSTOMER,
    "FactCustomerActivity": S.FACT_CUSTOMER_ACTIVITY,
    "KPIContext": S.KPI_CONTEXT,
    "ModelEvaluation": S.MODEL_EVALUATION,
    "ModelImportance": S.MODEL_IMPORTANCE,
    "ScoreProfile": S.SCORE_PROFILE,
    "ScorePreview": S.SCORE_PREVIEW,
    "SummaryBatches": S.SUMMARY_BATCHES,
    "SummaryKeys": S.SUMMARY_KEYS,
}
BATCH_TABLES: dict[str, StructType] = {
    "FactSales": S.FACT_SALES,
    "SalesRejects": S.SALES_REJECTS,
    "AIInsights": S.INSIGHTS,
}
SNAPSHOT_TABLES: dict[str, StructType] = {
    "FactInventory": S.FACT_INVENTORY,
    "SalesGroups": S.SALES_GROUPS,
    "SalesRegions": S.SALES_REGIONS,
    "SalesOrders": S.SALES_ORDERS,
    "SalesCustomers": S.SALES_CUSTOMERS,
}
#: Batch tables whose keys are indexed, so that loads find known keys without scanning them.
INDEXED: dict[str, list[str]] = {"FactSales": ["OrderID", "OrderLineID"]}


def _computed() -> dict[str, Column]:
    return {"GrossMarginPct": unit_margin_percent(F.col("UnitPrice"), F.col("UnitCost"))}


COMPUTED = {"DimProduct": _computed}

#: Codec of facts and large staging tables, smaller than Spark's default.
CODEC = "zstd"
#: Dimensions keep the default codec: the planner guesses from the size of their files what can be broadcast.
LARGE_STAGING = {"SalesRaw", "InventoryRaw"}

_VERSION = StructType([StructField("version", IntegerType())])


class Warehouse:
    """Reads and writes the tables of one root folder on shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- reading ------------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        """Current content of a table; empty when it was never written."""
        if name in BATCH_TABLES:
            rows = self._scan(self._path(name), self._batch_schema(name))
            # One row per batch; as both are partition columns, other folders are not read.
            return rows.join(if_small(self._published(name)), [BATCH, ATTEMPT], "left_semi").drop(ATTEMPT)
        if name in SNAPSHOT_TABLES:
            return self._scan(self._path(name), SNAPSHOT_TABLES[name])
        version = self._version(name)
        if version == 0:
            return self._empty(TABLES[name])
        return self._scan(self._version_path(name, version), TABLES[name])

    def create_views(self, prefix: str = "") -> None:
        """Register every table as a temporary view for SQL users."""
        for name in [*TABLES, *BATCH_TABLES, *SNAPSHOT_TABLES]:
            self.read(name).createOrReplaceTempView(prefix + name)

    # --- writing ------------------------------------------------------------
    def replace(self, name: str, df: DataFrame, check: Callable[[], None] | None = None) -> DataFrame:
        """Replace a whole table; ``df`` may be computed from its current version.

        Computed columns get their values here, whatever the caller gave.  A
        dimension with a doubled business key is not published.  ``check`` runs
        when the version is written and before it is published; what it raises
        leaves the current version in place.  A table has one writer at a time.
        """
        version = self._version(name) + 1
        computed = df.withColumns(COMPUTED[name]()) if name in COMPUTED else df
        with shuffles_go(self.spark):
            codec = CODEC if name in LARGE_STAGING else None
            self._shaped(computed, TABLES[name]).write.mode("overwrite").parquet(self._version_path(name, version), compression=codec)
        if check is not None:
            check()
        if name in S.BUSINESS_KEYS:
            require_unique(self._scan(self._version_path(name, version), TABLES[name]), S.BUSINESS_KEYS[name])
        self._publish(f"{self._path(name)}/published", version)
        return self.read(name)

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """Write rows of any shape to a working table, replacing it, and read them back."""
        path = f"{self.root}/staging/{name}"
        with shuffles_go(self.spark):
            df.write.mode("overwrite").parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_batch(self, name: str, df: DataFrame, batch_id: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Append a batch, or replace it when the same batch is written again."""
        self.put_batches({name: df}, batch_id, derive)

    def put_batches(
        self, frames: dict[str, DataFrame], batch_id: str, derive: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Write one batch of several tables and publish it as a whole.

        Each attempt has its own folder.  Readers see the attempt that the
        batch's pointer names, in all tables or none, so a load that breaks off
        in between shows nothing new; running it again publishes a new attempt.

        Sales are dealt out by month before they are written.  Columns of the
        fact that ``derive`` adds from the others may be missing: they are
        computed behind that shuffle, which then need not move them.
        """
        names = "+".join(sorted(frames))
        pointer = f"{self.root}/batches/{names}/{BATCH}={batch_id}"
        mine = F.col(BATCH) == batch_id
        attempt = 1 + max(self._published(name).filter(mine).agg(F.coalesce(F.max(ATTEMPT), F.lit(0))).first()[0] for name in frames)
        for name, df in frames.items():
            path = f"{self._path(name)}/{BATCH}={batch_id}/{ATTEMPT}={attempt}"
            if name == "FactSales":
                # Rebalancing splits a hot month over several files and merges small ones.
                narrow = self._shaped(df, BATCH_TABLES[name], derive is not None)
                dealt = narrow.withColumn(MONTH, month_of_key(F.col("DateKey"))).hint("rebalance", MONTH)
                whole = dealt if derive is None else derive(dealt)
                writer = self._shaped(whole, StructType([*BATCH_TABLES[name], StructField(MONTH, IntegerType())])).write.partitionBy(MONTH)
            else:
                writer = self._shaped(df, BATCH_TABLES[name]).write
            with shuffles_go(self.spark):
                writer.mode("overwrite").parquet(path, compression=CODEC)
            if name in INDEXED:
                self.key_index(name).write(self.attempt_rows(name, batch_id, attempt), batch_id, attempt)
        self._publish(pointer, attempt)

    def put_snapshot(self, name: str, df: DataFrame, by_day: bool = False) -> None:
        """Replace the ``DateKey`` partitions present in ``df``; other dates survive.

        ``by_day`` says that the tasks which compute ``df`` have rows of one day
        each, or a few: they are written as they are, without a shuffle, in a
        file per task and day.
        """
        shaped = self._shaped(df, SNAPSHOT_TABLES[name])
        # Else a day is gathered in few files; the adaptive planner splits a large one.
        dealt = shaped if by_day else shaped.hint("rebalance", "DateKey")
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("DateKey")
        with shuffles_go(self.spark):
            writer.parquet(self._path(name), compression=CODEC)

    def key_index(self, name: str) -> KeyIndex:
        return KeyIndex(self, name, BATCH_TABLES[name], INDEXED[name])

    def attempt_rows(self, name: str, batch_id: str, attempt: int) -> DataFrame:
        """Rows of one attempt of a batch, published or not."""
        return self._scan(f"{self._path(name)}/{BATCH}={batch_id}/{ATTEMPT}={attempt}", BATCH_TABLES[name])

    # --- helpers ------------------------------------------------------------
    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _version_path(self, name: str, version: int) -> str:
        return f"{self._path(name)}/data/v{version:06d}"

    def _version(self, name: str) -> int:
        return self._pointed(f"{self._path(name)}/published")

    def _publish(self, pointer: str, number: int) -> None:
        """Add a row that names a version; the largest counts.  Of old rows there are few: each is a file of its own."""
        self.spark.range(1).select(F.lit(number).alias("version")).write.mode("append").parquet(pointer)

    def _pointed(self, pointer: str) -> int:
        return self._scan(pointer, _VERSION).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def _published(self, name: str) -> DataFrame:
        """Batch and attempt of every published batch that has this table."""
        pointers = self._scan(f"{self.root}/batches/*{name}*", StructType([*_VERSION.fields, StructField(BATCH, StringType())]))
        return pointers.groupBy(BATCH).agg(F.max("version").alias(ATTEMPT))

    def _scan(self, path: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._empty(schema)

    def _empty(self, schema: StructType) -> DataFrame:
        """No rows, known to the optimizer to be none."""
        nothing = F.lit(None)
        return self.spark.range(0).select(*[nothing.cast(f.dataType).alias(f.name) for f in schema])

    @staticmethod
    def _batch_schema(name: str) -> StructType:
        partitions = [StructField(BATCH, StringType()), StructField(ATTEMPT, IntegerType())]
        if name == "FactSales":
            partitions.append(StructField(MONTH, IntegerType()))
        return StructType([*BATCH_TABLES[name].fields, *partitions])

    @staticmethod
    def _shaped(df: DataFrame, schema: StructType, some: bool = False) -> DataFrame:
        """The columns of ``schema`` in its types, or ``some`` of them: those that ``df`` has."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if not some or f.name in df.columns])
