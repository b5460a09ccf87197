"""A small star schema with known results.

Fixed values: the expected totals in ``test_golden.py`` hold for these rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tillspark import schemas as S
from tillspark.plans.sales_load import with_measures

AS_OF = dt.date(2026, 3, 3)

DATES = [
    (20260101, "2026-01-01", 5, "Thursday", 1, 1, "January", 1, 2026, False, True, 2026, 1),
    (20260115, "2026-01-15", 5, "Thursday", 3, 1, "January", 1, 2026, False, False, 2026, 1),
    (20260201, "2026-02-01", 1, "Sunday", 5, 2, "February", 1, 2026, True, False, 2026, 1),
    (20260215, "2026-02-15", 1, "Sunday", 7, 2, "February", 1, 2026, True, False, 2026, 1),
    (20260301, "2026-03-01", 1, "Sunday", 9, 3, "March", 1, 2026, True, False, 2026, 1),
    (20260303, "2026-03-03", 3, "Tuesday", 10, 3, "March", 1, 2026, False, False, 2026, 1),
]
STORES = [
    ("STR001", "Houston Downtown", "South", "TX", "Houston", "Physical", "2019-03-01"),
    ("STR002", "Dallas Flagship", "South", "TX", "Dallas", "Physical", "2018-06-15"),
    ("STR003", "Online Store", "National", "N/A", "Online", "Online", "2020-01-01"),
    ("STR004", "Austin Outlet", "South", "TX", "Austin", "Outlet", "2021-09-10"),
    ("STR005", "New York", "Northeast", "NY", "New York", "Physical", "2017-11-01"),
]
PRODUCTS = [
    ("PRD001", "UltraSound Speaker Pro", "Electronics", "Audio", "SoundMax", "45.00", "129.99", "65.38"),
    ("PRD002", "EcoBlend Coffee Maker", "Appliances", "Kitchen", "BrewCo", "28.00", "79.99", "65.00"),
    ("PRD003", "ActiveFit Running Shoes", "Footwear", "Athletic", "StridePro", "32.00", "89.99", "64.44"),
    ("PRD004", "SmartHome Hub v3", "Electronics", "Smart Home", "NexaTech", "60.00", "199.99", "70.00"),
    ("PRD005", "OrganicBliss Skincare Set", "Beauty", "Skincare", "GlowNatural", "18.00", "54.99", "67.27"),
    ("PRD006", "Premium Yoga Mat", "Fitness", "Yoga", "ZenFlex", "12.00", "39.99", "69.99"),
    ("PRD007", "4K Action Camera", "Electronics", "Camera", "SnapVision", "75.00", "249.99", "70.00"),
    ("PRD008", "Stainless Steel Water Bottle", "Home", "Kitchen", "HydraMax", "8.00", "29.99", "73.32"),
]
CUSTOMERS = [
    ("CUST001", "Emma", "Johnson", "Premium", "South", "TX", "Houston", "2021-05-10", "0.1200", "Low"),
    ("CUST002", "Michael", "Chen", "Regular", "South", "TX", "Dallas", "2022-01-20", "0.4500", "Medium"),
    ("CUST003", "Aisha", "Patel", "At-Risk", "Northeast", "NY", "New York", "2020-08-15", "0.7800", "High"),
    ("CUST004", "Carlos", "Rivera", "Premium", "South", "TX", "Austin", "2019-11-30", "0.0800", "Low"),
    ("CUST005", "Sarah", "Williams", "Regular", "South", "TX", "Houston", "2023-03-05", "0.6200", "High"),
    ("CUST006", "James", "Kim", "Regular", "Northeast", "NY", "New York", "2022-07-22", "0.3300", "Medium"),
    ("CUST007", "Priya", "Sharma", "Premium", "South", "TX", "Dallas", "2021-02-14", "0.0500", "Low"),
    ("CUST008", "David", "Brown", "At-Risk", "South", "TX", "Houston", "2020-06-01", "0.8900", "High"),
]
# order, line, day, customer, product, store, quantity, price, discount, cost of goods
SALES = [
    ("ORD-2026-0001", 1, 20260101, 1, 1, 1, 2, "129.99", "0", "90.00"),
    ("ORD-2026-0001", 2, 20260101, 1, 5, 1, 1, "54.99", "10", "18.00"),
    ("ORD-2026-0002", 1, 20260115, 2, 2, 2, 1, "79.99", "0", "28.00"),
    ("ORD-2026-0003", 1, 20260115, 3, 4, 3, 1, "199.99", "5", "60.00"),
    ("ORD-2026-0004", 1, 20260201, 4, 7, 4, 1, "249.99", "0", "75.00"),
    ("ORD-2026-0005", 1, 20260201, 5, 3, 1, 2, "89.99", "15", "64.00"),
    ("ORD-2026-0006", 1, 20260215, 6, 6, 3, 3, "39.99", "0", "36.00"),
    ("ORD-2026-0007", 1, 20260215, 7, 1, 5, 1, "129.99", "10", "45.00"),
    ("ORD-2026-0008", 1, 20260301, 8, 8, 2, 2, "29.99", "0", "16.00"),
    ("ORD-2026-0009", 1, 20260303, 1, 4, 3, 1, "199.99", "0", "60.00"),
    ("ORD-2026-0010", 1, 20260303, 4, 2, 1, 2, "79.99", "5", "56.00"),
]


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


class GoldenStar:
    """The rows as frames, with keys 1..n in the order above."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        make = spark.createDataFrame
        self.dates = make([(r[0], day(r[1]), *r[2:]) for r in DATES], S.DIM_DATE)
        self.stores = make([(i, *r[:6], day(r[6]), True) for i, r in enumerate(STORES, 1)], S.DIM_STORE)
        self.products = make(
            [(i, *r[:5], *map(Decimal, r[5:]), True) for i, r in enumerate(PRODUCTS, 1)], S.DIM_PRODUCT
        )
        self.customers = make(
            [
                (i, r[0], r[1], r[2], f"{r[0].lower()}@mail.example", *r[3:7], None, day(r[7]), True)
                + (Decimal(r[8]), r[9], None)
                for i, r in enumerate(CUSTOMERS, 1)
            ],
            S.DIM_CUSTOMER,
        )
        self.tickets = make([], S.SUPPORT_TICKETS)
        self.fact = self._fact()

    def _fact(self) -> DataFrame:
        columns = (
            "OrderID string, OrderLineID int, DateKey int, CustomerKey long, ProductKey long, StoreKey long,"
            " Quantity int, UnitPrice decimal(10,2), Discount decimal(5,2), COGS decimal(10,2)"
        )
        rows = [(*r[:7], *map(Decimal, r[7:])) for r in SALES]
        return with_measures(self.spark.createDataFrame(rows, columns).selectExpr("*", "false AS ReturnFlag"))

    def sales_raw(self) -> DataFrame:
        """The same sales before the key lookup."""
        rows = [
            (
                order,
                line,
                CUSTOMERS[customer - 1][0],
                PRODUCTS[product - 1][0],
                STORES[store - 1][0],
                dt.datetime.strptime(str(date), "%Y%m%d").date(),
                quantity,
                Decimal(price),
                Decimal(discount),
                False,
                False,
                None,
            )
            for order, line, date, customer, product, store, quantity, price, discount, _ in SALES
        ]
        return self.spark.createDataFrame(rows, S.SALES_RAW)
