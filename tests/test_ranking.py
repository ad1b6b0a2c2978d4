"""global_rank / ntile equal the plain single-partition windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import global_rank, ntile_from_rank


def _frame(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, 1, 2, 2, 3, 5, 8]), float(rnd.randint(0, 40))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, v double")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions", [None, 1, 3, 8, 40])
def test_rank_and_running_sum_match_window(spark, descending, partitions):
    df = _frame(spark, 400, partitions or 2)
    order = [F.col("k").desc(), F.col("id").desc()] if descending else [F.col("k").asc(), F.col("id").asc()]
    w = Window.orderBy(*order)
    expected = {r.id: (r.rn, r.rs, r.n) for r in df.select(
        "id", F.row_number().over(w).alias("rn"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n")).collect()}
    got = global_rank(df, ["k", "id"], descending=descending, rank_col="rn", running_sum="v",
                      running_col="rs", total_count_col="n", partitions=partitions)
    assert {r.id: (r.rn, r.rs, r.n) for r in got.collect()} == expected


@pytest.mark.parametrize("n_rows,tiles", [(5, 4), (3, 5), (57, 8), (100, 5)])
def test_ntile_matches_window(spark, n_rows, tiles):
    df = _frame(spark, n_rows, n_rows)
    w = Window.orderBy("k", "id")
    expected = {r.id: r.t for r in df.select("id", F.ntile(tiles).over(w).alias("t")).collect()}
    ranked = global_rank(df, ["k", "id"], rank_col="r", total_count_col="n", partitions=3)
    got = {r.id: r.t for r in ranked.select("id", ntile_from_rank("r", "n", tiles).alias("t")).collect()}
    assert got == expected


def test_ntile_four_on_five_rows_sizes(spark):
    df = spark.range(5).withColumnRenamed("id", "x")
    ranked = global_rank(df, ["x"], rank_col="r", total_count_col="n")
    sizes = [r[1] for r in ranked.groupBy(ntile_from_rank("r", "n", 4).alias("t")).count().orderBy("t").collect()]
    assert sizes == [2, 1, 1, 1]


def test_plan_has_no_single_partition_exchange(spark):
    df = _frame(spark, 200, 1)
    plan = global_rank(df, ["k", "id"], rank_col="r", partitions=4)._jdf.queryExecution() \
        .executedPlan().toString()
    # the only single-partition window runs over the ranges' offsets (<= 4 rows)
    assert plan.count("SinglePartition") <= 1


def test_date_and_timestamp_keys(spark):
    df = spark.range(300).select(
        F.col("id"),
        F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 17).cast("int")).alias("d"),
        F.expr("timestampadd(HOUR, cast(id % 29 as int), timestamp_ntz'2018-01-01 00:00:00')").alias("t"))
    for cols in (["d", "id"], ["t", "id"]):
        w = Window.orderBy(*cols)
        expected = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
        got = global_rank(df, cols, rank_col="rn", partitions=6)
        assert {r.id: r.rn for r in got.collect()} == expected
