"""Every registered query that has SQL gives the rows its SQL gives on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, differences
from tagledger.suite.oracles import ORACLES
from tagledger.suite.queries import QUERIES

SF_DIR = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    """Of the core; the operators on training text have SQL only where it can express them."""
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    found = contract.queries()[name](spark, SF_DIR)
    assert differences(found, connection, contract.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
