"""Every registered query against its SQL on the smallest table set."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.core_queries(), entry_module.core_oracle_sql()
pytestmark = pytest.mark.skipif(not Path(TABLES).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    found = QUERIES[name](spark, TABLES)
    expected = database.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = sorted((tuple(row[c] for c in columns) for row in found.collect()), key=repr)
    places = [expected.columns.index(c) for c in columns]
    assert rows == sorted((tuple(row[p] for p in places) for row in expected.fetchall()), key=repr)


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0
