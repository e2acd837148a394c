import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from veld.llm.store import ship_package
    ship_package(spark)
