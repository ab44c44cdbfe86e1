"""Every registered query against its SQL twin, on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registry
from pagetrove.plans import catalog, oracles

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(record[i] for i in order) for record in records]
    return sorted(made, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, abs_tol=1e-9)
    return a == b


def test_every_query_has_a_twin():
    assert {query.__name__ for query in catalog.QUERIES} == set(oracles.ORACLES)


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query(spark, twin, name):
    df = registry.queries()[name](spark, FOLDER)
    result = twin.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    ours, theirs = rows(df.columns, df.collect()), rows(result.columns, result.fetchall())
    assert ours and len(ours) == len(theirs)
    assert all(same(a, b) for x, y in zip(ours, theirs) for a, b in zip(x, y))
