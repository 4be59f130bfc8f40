"""Every query against its SQL in DuckDB, value by value, with equal types."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from reqmart.star.oracle import ORACLE
from reqmart.star.queries import QUERIES
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    answer = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    order = [[c[0] for c in answer.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in answer.fetchall()), key=repr)
    actual = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    assert len(actual) > 0
    assert actual == expected


def test_entry_runs(spark):
    assert not entry.entry(spark).isEmpty()
