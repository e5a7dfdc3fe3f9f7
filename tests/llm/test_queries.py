"""Queries against their SQL on the driver's smallest tables."""

import os

import duckdb
import pytest

from tessera.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found, expected = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).fetchdf()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = lambda f: sorted(tuple(map(str, r)) for r in f[columns].itertuples(index=False))
    assert rows(found) == rows(expected)
