from __future__ import annotations

import pytest

from tests.golden_rows import GoldenStar
from tillspark.session import build_session
from tillspark.sources.warehouse import Warehouse


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="10000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    return GoldenStar(spark)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


@pytest.fixture
def golden_warehouse(warehouse, golden):
    """Warehouse with the golden dimensions and no facts."""
    warehouse.replace("DimDate", golden.dates)
    warehouse.replace("DimStore", golden.stores)
    warehouse.replace("DimProduct", golden.products)
    warehouse.replace("DimCustomer", golden.customers)
    return warehouse
