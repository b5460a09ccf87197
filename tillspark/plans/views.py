"""The four report views over a warehouse, for DataFrame and SQL users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tillspark.operators.joins import lookup
from tillspark.plans import customers, inventory, sales
from tillspark.plans.access import visible_to
from tillspark.sources.warehouse import Warehouse


def _stores(warehouse: Warehouse, principal: str | None, role: str) -> DataFrame:
    stores = warehouse.read("DimStore")
    return stores if principal is None else visible_to(stores, warehouse.read("UserRegions"), principal, role)


def sales_summary(warehouse: Warehouse, principal: str | None = None, role: str = "RegionManagers") -> DataFrame:
    """Sales of the stores the principal may see."""
    read = warehouse.read
    return sales.sales_summary(
        read("FactSales"), read("DimDate"), _stores(warehouse, principal, role), read("DimProduct"), read("DimCustomer")
    )


def churn_dashboard(warehouse: Warehouse, principal: str | None = None, role: str = "RegionManagers") -> DataFrame:
    """Customers of the principal's regions; a customer has a region of its own and no store."""
    members = warehouse.read("DimCustomer")
    if principal is not None:
        members = visible_to(members, warehouse.read("UserRegions"), principal, role)
    return customers.churn_dashboard(members, warehouse.read("FactCustomerActivity"))


def inventory_intelligence(warehouse: Warehouse, principal: str | None = None, role: str = "RegionManagers") -> DataFrame:
    """Stock of the stores the principal may see."""
    read = warehouse.read
    return inventory.inventory_intelligence(
        read("FactInventory"), read("DimProduct"), _stores(warehouse, principal, role), read("DimDate")
    )


def kpi_summary(
    warehouse: Warehouse, as_of: dt.date, principal: str | None = None, role: str = "RegionManagers"
) -> DataFrame:
    """One row without a region: its sales, customers and stock are restricted before they are summed."""
    fact, members = warehouse.read("FactSales"), warehouse.read("DimCustomer")
    if principal is not None:
        fact = lookup(fact, _stores(warehouse, principal, role).select("StoreKey"), "StoreKey", "left_semi")
        members = visible_to(members, warehouse.read("UserRegions"), principal, role)
    return sales.kpi_summary(
        fact,
        members,
        churn_dashboard(warehouse, principal, role),
        inventory_intelligence(warehouse, principal, role),
        as_of,
    )


def register(
    warehouse: Warehouse, as_of: dt.date, principal: str | None = None, role: str = "RegionManagers"
) -> None:
    """Temporary views of the four reports, for one principal or for all regions; without a principal of the tables too.

    The tables themselves are not restricted, so a principal gets none of them.
    """
    if principal is None:
        warehouse.create_views()
    sales_summary(warehouse, principal, role).createOrReplaceTempView("vw_SalesSummary")
    churn_dashboard(warehouse, principal, role).createOrReplaceTempView("vw_ChurnRiskDashboard")
    inventory_intelligence(warehouse, principal, role).createOrReplaceTempView("vw_InventoryIntelligence")
    kpi_summary(warehouse, as_of, principal, role).createOrReplaceTempView("vw_KPISummary")
