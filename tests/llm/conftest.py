import pytest

from tagledger.llm.tables import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SMALL, "documents").cache()


@pytest.fixture(autouse=True)
def _workers_find_the_package(spark):
    table(spark, SMALL, "region")
