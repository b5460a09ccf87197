"""From sales staging to the sales fact: rejects, lookups, deduplication."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.fixed_values import REJECT_REASON
from tillspark.functions.dates import date_key
from tillspark.functions.money import MONEY, gross_sales, net_sales
from tillspark.functions.rules import is_loadable, is_rejected
from tillspark.operators.joins import if_few, if_small, lookup, not_in, occurring
from tillspark.schemas import FACT_SALES
from tillspark.sources.warehouse import BATCH, Warehouse

LINE_KEY = ["OrderID", "OrderLineID"]
#: Columns of the fact that :func:`with_measures` computes.
MEASURES = ["GrossSales", "NetSales", "GrossProfit"]


MISSING_LINE, MISSING_DATE, UNREADABLE = "Line number missing", "Date not in calendar", "Line not readable"


class InvalidSaleError(ValueError):
    """A sale that passed the checks has no line number or no calendar day, which the fact requires."""


def rejects(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Reject log entries of a batch."""
    return raw.filter(is_rejected()).select(
        "OrderID", F.lit(REJECT_REASON).alias("RejectReason"), F.lit(as_of).cast("timestamp").alias("RejectDate")
    )


def unreadable_lines(lines: DataFrame, text: str, as_of: dt.date) -> DataFrame:
    """Reject log entries of lines that do not fit the schema; ``text`` names the column with the line as it came."""
    reason = F.concat(F.lit(f"{UNREADABLE}: "), F.col(text))
    return lines.select("OrderID", reason.alias("RejectReason"), F.lit(as_of).cast("timestamp").alias("RejectDate"))


def with_measures(sales: DataFrame) -> DataFrame:
    """Add the computed columns of the fact: GrossSales, NetSales, GrossProfit."""
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    return (
        sales.withColumn("GrossSales", gross_sales(quantity, price))
        .withColumn("NetSales", net_sales(quantity, price, F.col("Discount")))
        .withColumn("GrossProfit", (F.col("NetSales") - F.col("COGS")).cast(MONEY))
    )


def new_facts(
    raw: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, loaded: DataFrame
) -> DataFrame:
    """Fact rows of a batch: valid, known in all three dimensions, not loaded before.

    Lines that occur twice inside one batch are both kept.
    """
    valid = not_in(raw.filter(is_loadable()), loaded, LINE_KEY)
    # Stores and products are few and need no shuffle: the one for the customers then moves keys instead of texts.
    keyed = valid.join(if_few(stores.select("StoreID", "StoreKey")), "StoreID")
    keyed = keyed.join(if_few(products.select("ProductID", "ProductKey", "UnitCost")), "ProductID")
    keyed = lookup(keyed, customers.select("CustomerID", "CustomerKey"), "CustomerID")
    derived = (
        keyed.withColumn("DateKey", date_key(F.col("OrderDate")))
        .withColumn("Discount", F.coalesce("Discount", F.lit(0)))
        .withColumn("ReturnFlag", F.coalesce("ReturnFlag", F.lit(False)))
        .withColumn("COGS", (F.col("UnitCost") * F.col("Quantity")).cast(MONEY))
    )
    measured = with_measures(derived)
    return measured.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SALES])


def marked_processed(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Staging after the load: every open row is marked, rejected and unmatched rows too."""
    is_open = ~F.col("ProcessedFlag")
    return raw.withColumn(
        "ProcessedDate", F.when(is_open, F.lit(as_of).cast("timestamp")).otherwise(F.col("ProcessedDate"))
    ).withColumn("ProcessedFlag", F.when(is_open, F.lit(True)).otherwise(F.col("ProcessedFlag")))


def outcomes(
    raw: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, loaded: DataFrame
) -> DataFrame:
    """What happens to each staging row; the first reason that applies wins."""

    def flag(dim: DataFrame, key: str, name: str) -> DataFrame:
        return dim.select(key).withColumn(name, F.lit(True))

    marked = lookup(raw, flag(customers, "CustomerID", "__customer"), "CustomerID", "left")
    marked = lookup(marked, flag(products, "ProductID", "__product"), "ProductID", "left")
    marked = lookup(marked, flag(stores, "StoreID", "__store"), "StoreID", "left")
    repeats = occurring(raw, loaded, LINE_KEY).distinct()
    marked = marked.join(repeats.withColumn("__loaded", F.lit(True)), LINE_KEY, "left")
    outcome = (
        F.when(is_rejected(), "rejected")
        .when(F.col("Quantity").isNull() | F.col("UnitPrice").isNull(), "missing quantity or price")
        .when(F.col("__customer").isNull(), "unknown customer")
        .when(F.col("__product").isNull(), "unknown product")
        .when(F.col("__store").isNull(), "unknown store")
        .when(F.col("__loaded").isNotNull(), "already loaded")
        .otherwise("loaded")
    )
    return marked.select(*raw.columns, outcome.alias("Outcome"))


def outcome_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("Outcome").agg(F.count(F.lit(1)).alias("SalesLines"))


def silent_drops(classified: DataFrame) -> DataFrame:
    """Rows that were neither loaded nor logged as rejects, counted by reason."""
    silent: Column = ~F.col("Outcome").isin("loaded", "rejected", "already loaded")
    return outcome_counts(classified.filter(silent))


def _with_fault(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Add ``Fault``: why the fact cannot hold a row, else NULL."""
    days = dates.select("DateKey").withColumn("__day", F.lit(True))
    fault = F.when(F.col("OrderLineID").isNull(), MISSING_LINE).when(F.col("__day").isNull(), MISSING_DATE)
    return lookup(sales, days, "DateKey", "left").withColumn("Fault", fault).drop("__day")


def _may_be_faulty(raw: DataFrame, dates: DataFrame) -> bool:
    """Look at the different days of a batch only, not at its sales."""
    line = F.when(F.col("OrderLineID").isNotNull(), F.lit(0)).alias("OrderLineID")
    kinds = raw.filter(is_loadable()).select(date_key(F.col("OrderDate")).alias("DateKey"), line).distinct()
    return not _with_fault(kinds, dates).filter(F.col("Fault").isNotNull()).isEmpty()


def _new_lines(warehouse: Warehouse, raw: DataFrame, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of a batch and the loaded keys that are still to be compared with them.

    A large batch is shuffled to meet the loaded keys.  Its new lines are
    written, with no key left to compare: so these shuffle files go before the
    next shuffles need the disk.  A small batch is taken as it is.
    """
    valid = raw.filter(is_loadable())
    keys = valid.select(*LINE_KEY)
    if if_small(keys) is not keys or loaded.isEmpty():
        return raw, loaded
    return warehouse.staged("NewSales", not_in(valid, loaded, LINE_KEY)), loaded.limit(0)


@dataclass
class LoadCounts:
    """Rows written by one load."""

    inserted: int
    rejected: int


def load_sales(
    warehouse: Warehouse,
    raw: DataFrame,
    as_of: dt.date,
    batch_id: str,
    reject_invalid: bool = False,
    more_rejects: DataFrame | None = None,
) -> LoadCounts:
    """Load one batch into the warehouse.

    Facts and rejects are written as the batch ``batch_id``.  A replay compares
    with the other batches only and replaces its own folders, so a load that
    broke off half-way is repaired by running it again.  A sale the fact cannot
    hold stops the load before anything is written; ``reject_invalid`` logs it
    as a reject instead.  ``more_rejects`` are logged with the batch.

    Facts and rejects become visible together, when the batch is published.
    Lines that are loaded already are found in the index of keys; no fact is read.
    """
    index = warehouse.key_index("FactSales")
    index.complete()
    loaded = index.seen(raw.filter(is_loadable()), but=batch_id)
    dates = warehouse.read("DimDate")
    lines, known = _new_lines(warehouse, raw, loaded)
    facts = new_facts(
        lines, warehouse.read("DimCustomer"), warehouse.read("DimProduct"), warehouse.read("DimStore"), known
    )
    log = rejects(raw, as_of)
    if more_rejects is not None:
        log = log.unionByName(more_rejects)
    if _may_be_faulty(raw, dates):
        checked = _with_fault(facts, dates)
        faulty = checked.filter(F.col("Fault").isNotNull())
        if not reject_invalid:
            example = faulty.limit(1).collect()
            if example:
                raise InvalidSaleError(f"{example[0].Fault}: {example[0].asDict()}")
        log = log.unionByName(
            faulty.select(
                "OrderID", F.col("Fault").alias("RejectReason"), F.lit(as_of).cast("timestamp").alias("RejectDate")
            )
        )
        facts = checked.filter(F.col("Fault").isNull()).drop("Fault")
    warehouse.put_batches({"FactSales": facts.drop(*MEASURES), "SalesRejects": log}, batch_id, with_measures)
    mine = F.col(BATCH) == batch_id
    return LoadCounts(
        inserted=warehouse.read("FactSales").filter(mine).count(),
        rejected=warehouse.read("SalesRejects").filter(mine).count(),
    )
