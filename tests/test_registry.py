"""Every registered query against its SQL statement in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from barwright import registry

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = duck.sql(registry.ORACLES[name])
    assert sorted(expected.columns) == columns
    kinds = dict(df.dtypes)
    assert {c: KINDS[str(t)] for c, t in zip(expected.columns, expected.types)} == kinds
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    positions = [expected.columns.index(c) for c in columns]
    want = [tuple(row[i] for i in positions) for row in expected.fetchall()]
    assert ordered(got) == ordered(want)


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
