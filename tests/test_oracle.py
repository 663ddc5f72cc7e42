"""Every registered query against its SQL, value by value."""

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from tripflow.catalog.oracle import ORACLE
from tripflow.catalog.queries import QUERIES

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{TESTDATA}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLE.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, sql):
    result = queries()[name](spark, TESTDATA)
    expected = sql.sql(oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)

    sql_types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[kind] for c, kind in result.dtypes} == sql_types

    places = [expected.columns.index(c) for c in columns]
    ours = sorted(repr([row[c] for c in columns]) for row in result.collect())
    theirs = sorted(repr([row[p] for p in places]) for row in expected.fetchall())
    assert ours == theirs
    assert ours


def test_entry(spark):
    assert entry(spark).count() == 75
