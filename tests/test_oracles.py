"""Every registered query against its SQL on the driver's tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from voltdrift.driver.oracles import ORACLES
from voltdrift.driver.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def normal(rows, columns):
    """Rows with columns in name order, sorted, NaN-free and comparable."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def test_same_keys():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    names = [c[0] for c in result.description]
    expected = normal(result.fetchall(), names)
    assert sorted(df.columns) == sorted(names)
    actual = normal([tuple(r) for r in df.collect()], df.columns)
    assert len(actual) == len(expected)
    assert actual == expected
    assert actual


def test_entry(spark):
    assert entry(spark).count() > 0
