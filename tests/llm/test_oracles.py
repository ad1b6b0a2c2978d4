"""Queries that SQL can express against their SQL."""

import os

import duckdb
import pytest

from mercato.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("key", sorted(llm_oracles()))
def test_query_matches_sql(spark, con, key):
    want = con.sql(llm_oracles()[key])
    df = llm_queries()[key](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in df.select(*want.columns).collect()) == sorted(want.fetchall())
