"""Versioned tables: counts taken in the write, one pointer, failed loads invisible."""

import pytest
from pyspark.sql import functions as F

from mercato.operators.quality import DataQualityError
from mercato.plans import build as B
from mercato.plans.layers import Layers
from mercato.schemas import RAW_TABLE_NAMES
from mercato.sources.raw import ingest_all, validated
from mercato.sources.store import TableStore
from tests.helpers import item, make_raw, order


def test_counts_are_taken_in_the_write(spark, tmp_dir):
    load = TableStore(spark, tmp_dir).load()
    df = spark.createDataFrame([(1, "x", None), (2, None, 2.0), (None, None, 1.0)], "a long, `b.c` string, d double")
    back = load.write("t", df)
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert load.written["t"].rows == 3 and load.written["t"].nulls == {"a": 1, "b.c": 2, "d": 1}
    assert load.write("none", df.limit(0)).count() == 0 and load.written["none"].rows == 0


def test_load_is_one_pass(spark, tmp_dir):
    """A table that is validated, counted and written is evaluated once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    TableStore(spark, tmp_dir).load().write("t", spark.range(100).mapInArrow(count, "id long"), allow_empty=False)
    assert seen.value == 100


def test_nothing_is_visible_before_publish(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    assert store.tables() == {}
    with pytest.raises(KeyError):
        store.read("t")
    first = store.load()
    first.write("t", spark.range(3))
    first.write("u", spark.range(1))
    assert store.tables() == {}
    first.publish()
    old = store.read("t")
    second = store.load()
    second.write("t", spark.range(5))
    assert store.read("t").count() == 3
    second.publish()
    assert store.read("t").count() == 5 and store.read("u").count() == 1
    assert old.count() == 3  # opened before: still whole


def test_write_dispositions(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)

    def load(mode, n, **how):
        one = store.load()
        one.write("t", spark.range(n).withColumn("p", F.col("id") % 2), mode=mode, partition_by=["p"], **how)
        one.publish()

    load("WRITE_EMPTY", 0)
    load("WRITE_EMPTY", 4)
    with pytest.raises(ValueError, match="already"):
        load("WRITE_EMPTY", 4)
    load("WRITE_APPEND", 6)
    assert store.read("t").count() == store.tables()["t"].rows == 10 and store.read("t").columns == ["id", "p"]
    load("WRITE_TRUNCATE", 2)
    assert store.read("t").count() == 2
    for bad in ({"mode": "replace", "n": 1}, {"mode": "overwrite", "n": 0, "allow_empty": False}):
        with pytest.raises(ValueError):
            load(**bad)
    with pytest.raises(ValueError, match="columns differ"):
        store.load().write("t", spark.range(2), mode="append")
    with pytest.raises(ValueError, match="duplicate"):
        store.load().write("t", spark.range(2).select("id", F.col("id")))
    assert store.read("t").count() == 2


def _csv(spark, raw, folder):
    for name in RAW_TABLE_NAMES:
        getattr(raw, name).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")


def test_failed_ingest_leaves_the_tables_before(spark, tmp_dir):
    rows = {"orders": [order(1)], "order_items": [item(1, 1)], "order_payments": [(1, 1, "card", 1, 5.0)],
            "order_reviews": [(1, 1, 5, None, "a\n\"b\"", "2018-01-24 00:00:00", "2018-01-25 00:00:00")]}
    raw = make_raw(spark, **{k: v for k, v in rows.items() if k != "order_payments"})
    payments = spark.createDataFrame([(1, 1, "card", 1)], "a long, b long, c string, d long").select(
        "a", "b", "c", "d", F.lit("5.00").cast("decimal(18,2)").alias("v")).toDF(*raw.order_payments.columns)
    raw = type(raw)(**{**raw.as_dict(), "order_payments": payments})
    _csv(spark, raw, f"{tmp_dir}/csv")
    report = ingest_all(spark, f"{tmp_dir}/csv", f"{tmp_dir}/raw", id_type="bigint")
    assert {r.table_name: r.row_count for r in report.collect()} == {n: getattr(raw, n).count() for n in RAW_TABLE_NAMES}
    held = Layers.from_raw_dir(spark, f"{tmp_dir}/raw")
    assert held.raw.order_reviews.first().review_comment_message == 'a\n"b"'
    _csv(spark, make_raw(spark, orders=[order(1), order(2)], order_items=[]), f"{tmp_dir}/csv2")
    with pytest.raises(ValueError, match="empty"):
        ingest_all(spark, f"{tmp_dir}/csv2", f"{tmp_dir}/raw", id_type="bigint")
    assert Layers.from_raw_dir(spark, f"{tmp_dir}/raw").raw.orders.count() == 1


def test_validation_report_raises_for_empty_tables(spark):
    assert validated({"t": spark.range(2)}).first().validation == "accepted"
    with pytest.raises(Exception, match="load refused"):
        validated({"t": spark.range(0)}).collect()
    with pytest.raises(ValueError, match="duplicate"):
        validated({"t": spark.range(1).select("id", "id")})


@pytest.mark.parametrize("stage", ["mart_seller_from_lines", "checks", "publish"])
def test_killed_build_leaves_the_marts_before(spark, tmp_dir, monkeypatch, stage):
    def layers(n):
        return Layers(make_raw(spark, orders=[order(i) for i in range(1, n + 1)], order_items=[item(i, 1) for i in range(1, n + 1)]))

    B.build_marts(spark, layers(2), tmp_dir, gate=False)

    def die(*_, **__):
        raise DataQualityError("killed")

    if stage == "publish":
        monkeypatch.setattr("mercato.sources.store.Load.publish", die)
    elif stage == "checks":
        monkeypatch.setattr(B, "run_checks", lambda *a: None)
        calls = iter([None, None])
        monkeypatch.setattr(B, "assert_passed", lambda *a: next(calls, 1) and die())
    else:
        monkeypatch.setattr(B.M, stage, die)
    with pytest.raises(DataQualityError):
        B.build_marts(spark, layers(3), tmp_dir, gate=stage == "checks")
    marts = B.open_marts(spark, tmp_dir)
    assert marts.fct_orders.count() == 2 and marts.mart_seller_performance.first().total_orders == 2
    monkeypatch.undo()
    built = B.build_marts(spark, layers(3), tmp_dir, gate=False)
    opened = B.open_marts(spark, tmp_dir)
    assert opened.fct_orders.count() == 3 and opened.mart_category_performance.schema == built.mart_category_performance.schema
