"""One day's work in dependency order; a scheduler outside calls it once a day."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import schemas as S
from tillspark.fixed_values import INSIGHT_AREAS
from tillspark.operators.joins import scanned_bytes
from tillspark.operators.updates import require_unique
from tillspark.plans import churn_model, customers, insights, inventory, sales, sales_load, views
from tillspark.session import size_shuffles
from tillspark.sources import extracts
from tillspark.sources.warehouse import BATCH, Warehouse

log = logging.getLogger(__name__)


def copy_extracts(warehouse: Warehouse, landing: str, keep_corrupt: bool = False) -> None:
    """Replace the three staging tables with the extracts of the landing folder.

    Lines that do not fit their schema stop the day, unless ``keep_corrupt``
    lets them pass with NULLs.  They are counted while the tables are written,
    and a table is published only after that.
    """
    for name, pattern, schema in (
        ("SalesRaw", extracts.SALES_FILES, S.SALES_EXTRACT),
        ("CustomerRaw", extracts.CUSTOMER_FILES, S.CUSTOMER_EXTRACT),
        ("InventoryRaw", extracts.INVENTORY_FILES, S.INVENTORY_EXTRACT),
    ):
        lines, corrupt = extracts.count_corrupt(extracts.read_extract(warehouse.spark, landing, pattern, schema))

        def check(corrupt=corrupt, pattern=pattern) -> None:
            if corrupt() and not keep_corrupt:
                raise extracts.CorruptExtractError(f"{corrupt()} lines of {landing}/{pattern} do not fit the schema")

        warehouse.replace(name, extracts.as_sales_raw(lines) if name == "SalesRaw" else lines, check)


def refresh_sales(warehouse: Warehouse, as_of: dt.date, batch_id: str) -> sales_load.LoadCounts:
    """Load the staged sales and mark them processed."""
    staged = warehouse.read("SalesRaw")
    counts = sales_load.load_sales(warehouse, staged, as_of, batch_id)
    warehouse.replace("SalesRaw", sales_load.marked_processed(staged, as_of))
    return counts


def refresh_activity(warehouse: Warehouse, as_of: dt.date) -> DataFrame:
    read = warehouse.read
    activity = customers.customer_activity(
        read("DimCustomer"), read("FactSales"), read("DimDate"), read("DimProduct"), read("SupportTickets"), as_of
    )
    return warehouse.replace("FactCustomerActivity", activity)


def refresh_scores(warehouse: Warehouse, as_of: dt.date, model_path: str) -> DataFrame:
    """Score all active customers and apply the scores to the dimension.

    A model that is trained here is evaluated on the test rows; profile and
    preview are those of the new scores.
    """
    dim = warehouse.read("DimCustomer")
    features = churn_model.load_features(dim, warehouse.read("FactCustomerActivity"), as_of)
    prepared = churn_model.prepare_features(features)
    known = churn_model.is_saved(warehouse.spark, model_path)
    model = churn_model.train_or_load(prepared, model_path)
    if not known:
        test = churn_model.split_by_label(prepared)[1]
        if model.stages[-1].numClasses < 2 or test.isEmpty():
            log.warning("too few customers, or of one class only, to evaluate the model")
        else:
            warehouse.replace("ModelEvaluation", churn_model.evaluate(model, test))
        warehouse.replace("ModelImportance", churn_model.feature_importance(model, warehouse.spark))
    scores = warehouse.replace("ChurnScores", churn_model.score(model, prepared, as_of))
    require_unique(scores, ["CustomerID"])
    warehouse.replace("ScoreProfile", churn_model.score_profile(scores))
    warehouse.replace("ScorePreview", churn_model.score_preview(scores))
    warehouse.replace("DimCustomer", customers.apply_churn_scores(dim, scores, as_of))
    return scores


def refresh_inventory(warehouse: Warehouse, as_of: dt.date) -> None:
    read = warehouse.read
    snapshot = inventory.inventory_snapshot(
        read("InventoryRaw"), read("DimProduct"), read("DimStore"), read("FactSales"), as_of
    )
    warehouse.put_snapshot("FactInventory", snapshot, by_day=True)


def refresh_context(warehouse: Warehouse, as_of: dt.date) -> DataFrame:
    """KPI context of the warehouse as it is; stored, because prompts and insights both quote it."""
    read = warehouse.read
    fact, products = read("FactSales"), read("DimProduct")
    churn, stock = views.churn_dashboard(warehouse), views.inventory_intelligence(warehouse)
    context = insights.kpi_context(
        views.kpi_summary(warehouse, as_of),
        sales.top_product_groups(fact, products, as_of),
        customers.churn_by_region(churn),
        inventory.inventory_alerts(stock),
    )
    return warehouse.replace("KPIContext", context)


def refresh_insights(
    warehouse: Warehouse,
    as_of: dt.date,
    batch_id: str,
    write_texts: Callable[[DataFrame], DataFrame],
    model_version: str = "",
) -> list[str]:
    """Write and store the insights area by area; the areas whose texts could not be written are logged and returned."""
    context = refresh_context(warehouse, as_of)
    prompts = insights.insight_prompts(insights.area_list(warehouse.spark), context, as_of)
    written, failed = [], []
    for area in INSIGHT_AREAS:
        try:
            texts = write_texts(prompts.filter(F.col("InsightArea") == area))
            rows = insights.as_insights(texts, context, model_version, as_of)
            written.append(warehouse.staged(f"Insight-{area}", rows))
        except Exception:
            log.exception("no insight for %s", area)
            failed.append(area)
    if written:
        insights.save_insights(warehouse, reduce(DataFrame.unionByName, written), batch_id)
    return failed


def run_day(
    warehouse: Warehouse,
    landing: str,
    as_of: dt.date,
    batch_id: str,
    model_path: str,
    write_texts: Callable[[DataFrame], DataFrame] | None = None,
    model_version: str = "",
) -> DataFrame:
    """Run every step for ``as_of``; a failing step stops the day, and the day can be run again.

    Only insights fail area by area: the others are stored.

    ``batch_id`` names this delivery and must differ between deliveries.
    Inventory runs after the sales load because it reads the sales fact.
    ``write_texts`` turns prompts into texts, one area at a time; without it no
    insights are stored.
    """
    copy_extracts(warehouse, landing)
    size_shuffles(warehouse.spark, sum(scanned_bytes(warehouse.read(t)) for t in ("FactSales", "SalesRaw")))
    warehouse.replace(
        "DimCustomer", customers.upsert_customers(warehouse.read("DimCustomer"), warehouse.read("CustomerRaw"))
    )
    refresh_sales(warehouse, as_of, batch_id)
    refresh_activity(warehouse, as_of)
    refresh_scores(warehouse, as_of, model_path)
    refresh_inventory(warehouse, as_of)
    if write_texts is not None:
        refresh_insights(warehouse, as_of, batch_id, write_texts, model_version)
    return day_report(warehouse, batch_id)


def day_report(warehouse: Warehouse, batch_id: str) -> DataFrame:
    """Rows per table after a day; batch tables count this batch."""

    def rows(name: str) -> DataFrame:
        table = warehouse.read(name)
        if BATCH in table.columns:
            table = table.filter(F.col(BATCH) == batch_id)
        return table.agg(F.count(F.lit(1)).alias("TableRows")).select(F.lit(name).alias("TableName"), "TableRows")

    names = [
        "SalesRaw",
        "CustomerRaw",
        "InventoryRaw",
        "DimCustomer",
        "FactSales",
        "SalesRejects",
        "FactCustomerActivity",
        "ChurnScores",
        "FactInventory",
        "AIInsights",
        "ModelEvaluation",
        "ModelImportance",
        "ScoreProfile",
        "ScorePreview",
    ]
    return reduce(DataFrame.unionByName, [rows(n) for n in names])
