"""Exact distinct counts by month, year and all time against brute force."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from mercato.operators import distinct_rollup

SCHEMA = "category string, member string, bought date"


def brute(rows):
    seen = defaultdict(set)
    for category, member, day in rows:
        if member is None:
            continue
        seen[category, "all", None].add(member)
        if day is not None:
            seen[category, "month", day.replace(day=1)].add(member)
            seen[category, "year", day.replace(month=1, day=1)].add(member)
    return {k: len(v) for k, v in seen.items()}


def counted(df):
    rows = distinct_rollup(df, ["category"], "member", "bought", "n").collect()
    got = {(r.category, r.level, r.period): r.n for r in rows}
    assert len(got) == len(rows)
    return got


def drawn(n):
    rng = random.Random(11)
    first = dt.date(1994, 6, 1)  # crosses several state words
    return [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.35 else f"c{rng.randrange(6)}",
             None if rng.random() < 0.05 else f"m{rng.randrange(40)}",
             None if rng.random() < 0.05 else first + dt.timedelta(days=rng.randrange(6000))) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_levels_match_brute_force(spark, partitions):
    rows = drawn(4000)
    assert counted(spark.createDataFrame(rows, SCHEMA).repartition(partitions)) == brute(rows)


def test_years_are_not_sums_of_months(spark):
    rows = [("a", "x", dt.date(1997, m, 3)) for m in range(1, 13)] + [("a", "x", dt.date(2004, 12, 31))]
    got = counted(spark.createDataFrame(rows, SCHEMA))
    assert got["a", "year", dt.date(1997, 1, 1)] == 1 and got["a", "all", None] == 1
    assert got == brute(rows)


def test_word_edges_and_early_dates(spark):
    days = [dt.date(y, m, 1) for y in (1, 4, 5, 1899, 1999, 2000, 2004, 2005, 9999) for m in (1, 12)]
    rows = [("a", f"m{i % 3}", d) for i, d in enumerate(days)]
    assert counted(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_rows(spark):
    rows = [("a", None, dt.date(2000, 1, 1)), ("b", "x", None), (None, "x", dt.date(2000, 2, 2)), ("b", "x", None)]
    assert counted(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert counted(spark.createDataFrame([], SCHEMA)) == {}


def test_states_are_merged_before_the_shuffle(spark):
    df = spark.range(200_000).selectExpr("'hot' AS category", "cast(id % 5 AS string) AS member",
                                         "date_add(date'1997-01-01', cast(id % 700 AS int)) AS bought")
    plan = distinct_rollup(df, ["category"], "member", "bought")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_bit_or" in plan
