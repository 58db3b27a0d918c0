"""Every registered query against its SQL in an independent engine."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from orderlake.checks.registry import ORACLE_SQL, QUERIES
from tests.tools import comparable

SF_DIR = os.environ.get("ORDERLAKE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    assert sorted(result.columns) == sorted(expected.column_names)
    rows = comparable(result.toArrow())
    assert len(rows) > 0
    assert rows == comparable(expected)
