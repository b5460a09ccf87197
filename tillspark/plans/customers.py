"""Customer activity, churn scores and the churn dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.fixed_values import TICKET_MONTHS
from tillspark.functions.dates import date_key_of, months_before
from tillspark.functions.rules import annual_value, churn_category, recommended_action, revenue_at_risk
from tillspark.operators.joins import if_few, lookup
from tillspark.operators.updates import update_matched, upsert_type1
from tillspark.schemas import FACT_CUSTOMER_ACTIVITY


def recent_tickets(tickets: DataFrame, as_of: dt.date) -> DataFrame:
    """Support tickets per customer in the last six months."""
    recent = F.col("CreatedDate") >= months_before(as_of, TICKET_MONTHS)
    return tickets.filter(recent).groupBy("CustomerID").agg(F.count(F.lit(1)).alias("TicketCount"))


def customer_activity(
    customers: DataFrame,
    fact: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    tickets: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """One row per active customer, with or without sales; returns count as sales.

    Sales are aggregated before they meet the customers and the calendar: a
    customer who owns a third of the fact is one row at these joins, and the
    distinct counts spread their work over orders and categories.
    """
    bought = fact.select("CustomerKey", "OrderID", "DateKey", "ProductKey", "NetSales")
    bought = bought.join(if_few(products.select("ProductKey", "Category")), "ProductKey", "left")
    totals = bought.groupBy("CustomerKey").agg(
        F.count_distinct("OrderID").alias("TotalOrders"),
        F.sum("NetSales").alias("TotalSpend"),
        F.avg("NetSales").alias("AvgOrderValue"),
        F.max("DateKey").alias("DateKey"),
        F.count_distinct("Category").alias("UniqueCategories"),
    )
    totals = lookup(totals, dates.select("DateKey", F.col("FullDate").alias("LastPurchase")), "DateKey", "left")
    active = customers.filter("IsActive").select("CustomerKey", "CustomerID")
    joined = active.join(totals.drop("DateKey"), "CustomerKey", "left").join(recent_tickets(tickets, as_of), "CustomerID", "left")
    columns = {
        "CustomerKey": F.col("CustomerKey"),
        "DateKey": F.lit(date_key_of(as_of)),
        "TotalOrders": F.coalesce("TotalOrders", F.lit(0)),
        "TotalSpend": F.col("TotalSpend"),
        "AvgOrderValue": F.col("AvgOrderValue"),
        "DaysSinceLastPurchase": F.datediff(F.lit(as_of), "LastPurchase"),
        "UniqueCategories": F.coalesce("UniqueCategories", F.lit(0)),
        "SupportTickets": F.coalesce("TicketCount", F.lit(0)),
    }
    return joined.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in FACT_CUSTOMER_ACTIVITY])


def apply_churn_scores(customers: DataFrame, scores: DataFrame, as_of: dt.date) -> DataFrame:
    """Customer dimension with new scores; customers without a score stay as they are."""
    probability = F.col("ChurnProbability")
    return update_matched(
        customers,
        scores.select("CustomerID", "ChurnProbability"),
        "CustomerID",
        {
            "ChurnRiskScore": probability,
            "ChurnRiskCategory": churn_category(probability),
            "LastScoredDate": F.lit(as_of),
        },
    )


def upsert_customers(customers: DataFrame, extract: DataFrame) -> DataFrame:
    """Customer dimension after a customer extract."""
    return upsert_type1(customers, extract, "CustomerID", "CustomerKey", {"IsActive": F.lit(True)})


def churn_dashboard(customers: DataFrame, activity: DataFrame) -> DataFrame:
    """Active customers with activity, risk and the revenue at stake."""
    facts = activity.drop("DateKey")
    value = F.col("AvgOrderValue")
    joined = customers.filter("IsActive").join(facts, "CustomerKey", "left")
    return joined.select(
        "CustomerID",
        F.concat("FirstName", F.lit(" "), "LastName").alias("CustomerName"),
        "Segment",
        "Region",
        "State",
        "ChurnRiskScore",
        "ChurnRiskCategory",
        "LastScoredDate",
        "TotalOrders",
        "TotalSpend",
        "AvgOrderValue",
        "DaysSinceLastPurchase",
        "UniqueCategories",
        "SupportTickets",
        annual_value(value).alias("EstimatedAnnualValue"),
        revenue_at_risk(F.col("ChurnRiskCategory"), value).alias("RevenueAtRisk"),
    )


def recommended_actions(customers: DataFrame) -> DataFrame:
    """Next step per scored customer."""
    category = F.col("ChurnRiskCategory")
    return customers.select(
        "CustomerID", "ChurnRiskScore", "ChurnRiskCategory", recommended_action(category).alias("RecommendedAction")
    )


def churn_by_region(dashboard: DataFrame) -> DataFrame:
    """High-risk customers and their revenue per region, largest first."""
    return (
        dashboard.filter(F.col("ChurnRiskCategory") == "High")
        .groupBy("Region")
        .agg(F.count(F.lit(1)).alias("HighChurnCustomers"), F.sum("RevenueAtRisk").alias("TotalAtRisk"))
        .orderBy(F.desc("TotalAtRisk"), F.asc("Region"))
    )
