"""Every registered query against its SQL, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyhouse.workload.oracles import ORACLES
from tallyhouse.workload.queries import QUERIES

SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["events", "lineitem", "customer"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as from read_parquet('{SF_DIR}/{table}.parquet')")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    found = queries()[name](spark, SF_DIR)
    result = database.execute(oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    types = {column[0]: str(column[1]) for column in result.description}
    assert {name: SQL_TYPES[kind] for name, kind in found.dtypes} == types
    want = Counter(result.fetchall())
    got = Counter(tuple(row) for row in found.select(*columns).collect())
    assert sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 7
    assert {row["day_name"] for row in rows if row["is_weekend"]} == {"Sunday"}
