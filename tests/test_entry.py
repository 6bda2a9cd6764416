"""Every registered query against its SQL, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(str, frame[columns].itertuples(index=False, name=None)))


# The queries of the text subpackage have tests of their own.
OWN = [name for name, query in registry.queries().items() if query.__module__ == registry.__name__]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, database, name):
    found = rows(registry.queries()[name](spark, str(DATA)).toPandas())
    assert found == rows(database.sql(registry.oracle_sql()[name]).df())
    assert found[1]


def test_every_query_has_sql():
    assert set(OWN) <= registry.oracle_sql().keys() <= registry.queries().keys()


def test_flagship(spark):
    assert registry.entry(spark).count() > 0
