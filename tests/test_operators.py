"""Operators and extensions on small hand-made frames."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pyspark.sql.types import LongType

from mercato.functions import norm_lower, norm_title, zip_text
from mercato.operators import bucketize, latest_per_key
from mercato.plans import extensions as X
from mercato.plans.layers import Layers
from tests.helpers import make_raw, order


def test_latest_per_key_equals_row_number_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 30), rnd.choice([None, 1, 2, 3, 3]), i, f"x{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, ts long, id long, payload string")
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("id").desc())
    expected = {tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                .where("rn = 1").drop("rn").collect()}
    got = {tuple(r) for r in latest_per_key(df, ["k"], ["ts", "id"]).collect()}
    assert got == expected


def test_latest_per_key_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(30000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 0, id) AS k", "if(id % 7 = 0, null, id % 50) AS ts", "id % 11 AS id", "repeat('c', 50) AS payload")
    latest = latest_per_key(df, ["k"], ["ts", "id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "WindowGroupLimit" in plan[plan.index("Exchange"):]  # below the exchange: on the map side
    expected = df.groupBy("k").agg(F.max(F.struct("ts", "id", "payload")).alias("m")).select("k", "m.*")
    assert latest.count() == 20001 and latest.exceptAll(expected).isEmpty()


def test_latest_per_key_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, None, "c"), (1, None, "d")], "k int, ts int, p string")
    assert {tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect()} == {(None, 2, "b"), (1, None, "d")}
    assert latest_per_key(df.limit(0), ["k"], ["ts"]).isEmpty()


def test_bucketize_labels_and_ranks(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (49.9,), (50.0,), (None,)], "v double")
    label, rank, labels = bucketize("v", [5, 10, 50])
    got = [(r.l, r.r) for r in df.select(label.alias("l"), rank.alias("r")).collect()]
    assert labels == ["0-5%", "5-10%", "10-50%", "50%+"]
    assert got == [("0-5%", 1), ("0-5%", 1), ("5-10%", 2), ("10-50%", 3), ("50%+", 4), ("50%+", 4)]


def test_haversine_known_distance(spark):
    # Sao Paulo -> Rio de Janeiro centre points: about 361 km
    d = spark.range(1).select(X.haversine_km(F.lit(-23.5505), F.lit(-46.6333),
                                             F.lit(-22.9068), F.lit(-43.1729)).alias("d")).first().d
    assert math.isclose(d, 361.0, abs_tol=5.0)


def test_cohort_fixed_window_counts_only_early_repeats(spark):
    customers = [(1, 100, "01001", "x", "sp"), (2, 100, "01001", "x", "sp"),
                 (3, 200, "01001", "x", "sp"), (4, 200, "01001", "x", "sp")]
    orders = [order(1, customer_id=1, purchased="2018-01-01 10:00:00"),
              order(2, customer_id=2, purchased="2018-03-01 10:00:00"),   # within 90 days
              order(3, customer_id=3, purchased="2018-01-05 10:00:00"),
              order(4, customer_id=4, purchased="2018-06-01 10:00:00")]   # after 90 days
    p = Layers(make_raw(spark, customers=customers, orders=orders))
    r = X.ext_cohort_fixed_window(p.fct_orders).first()
    assert (r.cohort_size, r.recompradores_janela) == (2, 1)


def test_seller_sla_share_on_time(spark):
    from tests.helpers import item
    orders = [order(1, carrier="2018-01-11 10:00:00"), order(2, carrier="2018-01-13 10:00:00"),
              order(3, status="processing", carrier=None, delivered=None)]
    items = [item(1, 1, seller_id=10, limit="2018-01-12 00:00:00"),
             item(2, 1, seller_id=10, limit="2018-01-12 00:00:00"),
             item(3, 1, seller_id=10, limit="2018-01-12 00:00:00")]
    p = Layers(make_raw(spark, orders=orders, order_items=items))
    r = X.ext_seller_sla(p.int_order_items_enriched, p.fct_orders).first()
    assert (r.shipped_items, r.on_time_items, r.pct_on_time) == (2, 1, 50.0)


def test_order_payments_aggregated_before_join(spark):
    from decimal import Decimal
    from tests.helpers import D, item
    payments = [(1, 1, "credit_card", 3, D(80)), (1, 2, " VOUCHER", 1, D(30)), (2, 1, "boleto", 1, D(5))]
    p = Layers(make_raw(spark, orders=[order(1), order(2), order(3)],
                        order_items=[item(1, 1, price=100, freight=10)],
                        order_payments=payments))
    got = {r.order_id: r for r in X.ext_order_payments(p.stg_order_payments, p.fct_orders).collect()}
    assert got[1].payment_total == Decimal("110.00") and got[1].payment_count == 2
    assert got[1].payment_types == 2 and got[1].voucher_value == Decimal("30.00")
    assert got[1].payment_gap == Decimal("0.00")
    assert got[3].payment_total is None


def test_zip_text_pads_but_never_cuts(spark):
    rows = spark.createDataFrame([(7,), (12345,), (123456,), (123457,), (None,)], "z long") \
        .select(zip_text("z", LongType())).collect()
    assert [r[0] for r in rows] == ["00007", "12345", "123456", "123457", None]


def test_trim_takes_all_white_space(spark):
    df = spark.createDataFrame([(" delivered\t",), (" Delivered\r\n",), ("a b",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(norm_lower("s")).collect()] == ["delivered", "delivered", "a b", "", None]


def test_title_starts_words_after_delimiters(spark):
    df = spark.createDataFrame([("xique-xique ",), ("SAO JOAO (rj)",), ("d'oeste/ms",), ("são-luís",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(norm_title("s")).collect()] == [
        "Xique-Xique", "Sao Joao (Rj)", "D'oeste/Ms", "São-Luís", None, ""]


def test_bucketize_keeps_nulls_apart_when_named(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "v double")
    label, rank, labels = bucketize("v", (5,), ["low", "high"], null_label="unknown")
    assert [tuple(r) for r in df.select(label, rank).collect()] == [("low", 1), ("high", 2), ("unknown", 3)]
    assert labels == ["low", "high", "unknown"]


def test_using_left_keeps_keys_missing_on_the_right(spark):
    from mercato.operators import using_left
    left = spark.createDataFrame([("a", 2017, 1, 5), ("a", 2017, 2, 6), ("b", 2018, 1, 7)], "c string, y int, m int, orders int")
    right = spark.createDataFrame([("a", 2017, 1, 3), ("b", 2017, 1, 9)], "c string, y int, m int, sellers int")
    out = using_left(left, right, ["c", "y", "m"])
    assert out.columns == ["c", "y", "m", "orders", "sellers"]
    assert sorted(map(tuple, out.collect())) == [("a", 2017, 1, 5, 3), ("a", 2017, 2, 6, None), ("b", 2018, 1, 7, None)]
