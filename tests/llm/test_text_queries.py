"""Text queries against their SQL, on whole tables, and what must hold of all."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
REPOSITORY = Path(__file__).parents[2]


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"create view {table} as from read_parquet('{SF_DIR}/{table}.parquet')")
    result = connection.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(row) for row in found.select(*columns).collect()) == Counter(result.fetchall())


def test_nothing_else_imports_the_subpackage():
    code = "import sys; sys.modules['tallyhouse.llm'] = None\nimport tallyhouse.__main__, tallyhouse.workload.queries"
    subprocess.run([sys.executable, "-c", code], cwd=REPOSITORY, check=True)


@pytest.mark.parametrize("name", ["op1_pii_pseudonyms", "op6_secret_scan", "op10_merkle_fingerprint", "op13_quality_outliers"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
