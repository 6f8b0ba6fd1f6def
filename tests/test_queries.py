"""Every query against its SQL, on whole tables of the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from postledger.proving import oracle, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_its_sql():
    assert list(registry.QUERIES) and set(registry.QUERIES) == set(oracle.SQL)
    assert registry.QUERIES.items() <= entry.queries().items() and oracle.SQL.items() <= entry.oracle_sql().items()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_equals_its_sql(spark, database, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted((tuple(repr(row[c]) for c in columns) for row in df.collect()))
    result = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(tuple(repr(row[i]) for i in places) for row in result.fetchall())
    assert found == expected
    assert found
