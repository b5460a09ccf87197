"""KPI context, prompts and stored narrative insights."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark import fixed_values as V
from tillspark.functions.dates import long_date, short_date
from tillspark.functions.money import number_or_zero
from tillspark.sources.warehouse import Warehouse

_JSON = {"ignoreNullFields": "false"}


def _list_of(df: DataFrame, order: list[Column], fields: dict[str, Column]) -> Column:
    """A small report as one ordered array of objects (scalar subquery)."""
    item = F.struct(*[c.alias(name) for name, c in fields.items()])
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    sorted_items = F.array_sort(F.collect_list(F.struct(*keys, item.alias("item"))))
    return df.agg(F.transform(sorted_items, lambda e: e["item"]).alias("items")).scalar()


def kpi_context(
    summary: DataFrame, top_products: DataFrame, churn_by_region: DataFrame, inventory_alerts: DataFrame
) -> DataFrame:
    """All key figures as one JSON document in one row: compact for storage, indented for reading."""
    products = _list_of(
        top_products,
        [-F.col("NetSales"), F.col("Category"), F.col("SubCategory")],
        {
            "category": F.col("Category"),
            "sub_category": F.col("SubCategory"),
            "net_sales": number_or_zero(F.col("NetSales"), "double"),
            "gross_profit": number_or_zero(F.col("GrossProfit"), "double"),
            "units_sold": number_or_zero(F.col("UnitsSold"), "long"),
        },
    )
    regions = _list_of(
        churn_by_region,
        [-F.coalesce("TotalAtRisk", F.lit(0)), F.col("Region")],
        {
            "region": F.col("Region"),
            "customers": F.col("HighChurnCustomers"),
            "revenue_at_risk": number_or_zero(F.col("TotalAtRisk"), "double"),
        },
    )
    alerts = _list_of(
        inventory_alerts,
        [F.col("DaysOfSupply"), F.col("ProductID"), F.col("StoreName")],
        {
            "product": F.col("ProductName"),
            "category": F.col("Category"),
            "store_type": F.col("StoreType"),
            "qty_on_hand": number_or_zero(F.col("QuantityOnHand"), "long"),
            "days_of_supply": number_or_zero(F.col("DaysOfSupply"), "long"),
            "risk": F.col("StockOutRisk"),
        },
    )
    document = F.struct(
        F.struct(*summary.columns).alias("summary"),
        products.alias("top_products"),
        regions.alias("churn_by_region"),
        alerts.alias("inventory_alerts"),
    )
    return summary.select(
        F.to_json(document, _JSON).alias("KPIContext"),
        F.to_json(document, {**_JSON, "pretty": "true"}).alias("KPIText"),
    )


def insight_prompts(areas: DataFrame, context: DataFrame, as_of: dt.date) -> DataFrame:
    """Prompt per row of ``areas`` (``InsightArea``); an unknown area gets the overall task."""
    task = F.lit(V.PROMPT_TASKS[V.FALLBACK_AREA])
    for area, text in V.PROMPT_TASKS.items():
        task = F.when(F.col("InsightArea") == area, F.lit(text)).otherwise(task)
    figures = context.select("KPIText").scalar()
    prompt = F.concat(
        F.lit(V.PROMPT_OPENING), long_date(F.lit(as_of)), F.lit(V.PROMPT_RULES), figures, F.lit("\n\n"), task
    )
    return areas.select("InsightArea", prompt.alias("Prompt"))


def area_list(spark: SparkSession) -> DataFrame:
    """The areas that insights are written for."""
    areas = F.array(*[F.lit(a) for a in V.INSIGHT_AREAS])
    return spark.range(0, 1, 1, 1).select(F.explode(areas).alias("InsightArea"))


def as_insights(texts: DataFrame, context: DataFrame, model_version: str, as_of: dt.date) -> DataFrame:
    """Insight rows from texts (``InsightArea``, ``InsightText``) written elsewhere."""
    return texts.select(
        F.lit(as_of).alias("InsightDate"),
        "InsightArea",
        F.trim("InsightText").alias("InsightText"),
        context.select("KPIContext").scalar().alias("KPIContext"),
        F.lit(model_version).alias("ModelVersion"),
        F.lit(as_of).cast("timestamp").alias("GeneratedAt"),
    )


def save_insights(warehouse: Warehouse, insights: DataFrame, batch_id: str) -> None:
    """Append insights; saving the same batch again replaces it."""
    warehouse.put_batch("AIInsights", insights, batch_id)


def latest_insights(insights: DataFrame, areas: DataFrame) -> DataFrame:
    """Per area the first text, in text order, of the latest day overall; NULL without one."""
    latest = insights.agg(F.max("InsightDate")).scalar()
    texts = (
        insights.filter(F.col("InsightDate") == latest)
        .groupBy("InsightArea")
        .agg(F.min("InsightText").alias("InsightText"))
    )
    return areas.join(texts, "InsightArea", "left")


def insights_last_updated(insights: DataFrame) -> DataFrame:
    """Label with the day of the newest insight."""
    label = F.concat(F.lit(V.INSIGHTS_LABEL), short_date(F.max("InsightDate")))
    return insights.agg(label.alias("InsightsLastUpdated"))
