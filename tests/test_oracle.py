"""Every query of the warehouse against its expected result in DuckDB."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle.queries import ORACLE
from tezgah.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
# Plan nodes no query may contain: joins without an equality, Python workers.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def _sorted(rows):
    clean = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows
    ]
    return sorted(clean, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    rows = frame.select(*columns).collect()
    assert rows
    if name not in ORACLE:
        return
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES.get(t) for c, t in frame.dtypes} == types
    expected = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert _sorted(rows) == _sorted(expected)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())
