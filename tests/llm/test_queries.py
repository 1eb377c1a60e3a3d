"""The registered queries: all there, and those that SQL can say, against their SQL."""

import duckdb
import pytest

from voltdrift.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = sorted(map(repr, result.fetchall()))
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in found.select(columns).collect()) == expected
