"""Sums that no partitioning changes; several ranks from one write; nearest keys against brute force."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions import exact_avg, exact_sum, weighted_mean
from mercato.operators import global_ranks
from mercato.operators.nearest import RINGS, nearest_key
from mercato.plans.extensions import centroids_for
from tests.helpers import make_raw


def test_sums_are_bit_equal_over_any_partitioning(spark):
    rng = random.Random(2)
    rows = [(i % 3, rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(-6, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, x double").withColumn("w", F.col("k") + 1)
    seen = set()
    for n in (1, 7, 200):
        out = df.repartition(n).groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), F.max(F.lit(1)).alias("one"), weighted_mean("x", "w", 9).alias("m"))
        seen.add(tuple(sorted(tuple(map(repr, r)) for r in out.collect())))
    assert len(seen) == 1
    for k, s, a, *_ in next(iter(seen)):
        exact = sum(Fraction(x) for j, x in rows if j == int(k))
        assert math.isclose(float(s), float(exact), rel_tol=1e-15) and math.isclose(float(a), float(exact / 1000), rel_tol=1e-15)


@pytest.mark.parametrize("values, total", [([], None), ([None, None], None), ([None, 1.5, -0.25], 1.25), ([-0.1] * 10, -1.0), ([1e15, 0.5], 1e15 + 0.5),
                                           ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan), ([math.nan, 1.0], math.nan), ([2.0**40, 2.0**-60], 2.0**40)])
def test_sum_of_odd_values(spark, values, total):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert got.s == total or math.isnan(total) and math.isnan(got.s)
    assert (got.a is None) == (total is None)


def test_staged_means_do_not_depend_on_partitions(spark):
    from mercato.plans.staging import stg_geolocation
    rng = random.Random(4)
    raw = make_raw(spark, geolocation=[(f"{i % 5:05d}", rng.uniform(-30, 5), rng.uniform(-70, -30), "x", "y") for i in range(2000)]).geolocation
    got = {tuple(sorted(map(repr, stg_geolocation(raw.repartition(n)).collect()))) for n in (1, 7, 200)}
    assert len(got) == 1


def test_ranks_of_several_orders_equal_windows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1.5, 2.5, 7.0]), rng.choice([None, "a", "b", "ü"]), [i]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, x double, s string, payload array<int>").repartition(6)
    orders = {"by_x": (["x", "id"], False), "by_s": (["s", "x", "id"], True), "by_id": (["id"], True)}
    from mercato.operators import ranking
    writes = []
    real = ranking.write_scratch_table
    monkeypatch.setattr(ranking, "write_scratch_table", lambda *a: writes.append(a[1]) or real(*a))
    got = global_ranks(df, orders, ["id"], total_count_col="n")
    assert len(writes) == 1 and got.columns == ["id", "x", "s", "payload", "by_x", "by_s", "by_id", "n"]
    want = df
    for name, (cols, down) in orders.items():
        want = want.withColumn(name, F.row_number().over(Window.orderBy(*[F.col(c).desc() if down else F.col(c).asc() for c in cols])).cast("long"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.withColumn("n", F.lit(500).cast("long")).collect()))
    assert got.schema["by_s"].dataType == want.schema["by_s"].dataType
    assert global_ranks(df.limit(0), orders, ["id"]).count() == 0


def test_nearest_key_equals_brute_force(spark):
    rng = random.Random(6)
    known = rng.sample(range(20_000), 300)
    wanted = rng.sample(range(24_000), 800) + [None]
    got = nearest_key(spark.createDataFrame([(w,) for w in wanted], "w long"), spark.createDataFrame([(k, f"k{k}") for k in known], "k long, name string"),
                      F.col("w"), F.col("k"))
    best = {w: min((abs(w - k), k) for k in known) for w in wanted if w is not None}
    assert {r.w: (r.apart, r.found.k) for r in got.collect()} == {w: b for w, b in best.items() if b[0] <= RINGS[-1]}
    assert got.filter("found.name != concat('k', found.k)").isEmpty()


def test_centroids_of_zips_without_one(spark):
    geo = spark.createDataFrame([("01001", 1.0, 2.0), ("01009", 3.0, 4.0), ("1009", 5.0, 6.0), ("80000", 7.0, 8.0), ("X1", 9.0, 9.0)], "zip_code_prefix string, lat double, lng double")
    zips = spark.createDataFrame([("01001",), ("01005",), ("01006",), ("80999",), ("81001",), ("X1",), ("X2",)], "zip_code_prefix string")
    got = {r.zip_code_prefix: (r.lat, r.lng) for r in centroids_for(zips, geo).collect()}
    assert got == {"01001": (1.0, 2.0), "01005": (1.0, 2.0), "01006": (3.0, 4.0), "80999": (7.0, 8.0), "X1": (9.0, 9.0)}
