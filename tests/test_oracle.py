"""Every registered query equals its DuckDB oracle on the smallest test scale."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from mercato.plans.registry import all_queries
from mercato.testing.oracle_queries import oracle_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES, ORACLE = all_queries(), oracle_queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return str(v)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(cols)
    names = sorted(cols)
    got = sorted(tuple(_norm(r[c]) for c in names) for r in sdf.collect())
    exp = sorted(tuple(_norm(dict(zip(cols, r))[c]) for c in names) for r in cur.fetchall())
    assert got == exp


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle_binds(con, key):
    """Every SQL text is valid, told before the long comparisons."""
    con.execute("EXPLAIN " + ORACLE[key])
