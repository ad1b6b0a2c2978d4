"""Tasks hold a bounded share of the shuffled rows, whatever the input's size."""

import pytest

from mercato.plans.layers import Layers
from mercato.session import TASK_SIZE, TASK_SIZE_KEY, ensure_task_size
from mercato.sources.testdata import raw_order_items


@pytest.fixture()
def size_conf(spark):
    saved = spark.conf.get(TASK_SIZE_KEY, None)
    spark.conf.unset(TASK_SIZE_KEY)
    yield spark.conf
    spark.conf.unset(TASK_SIZE_KEY)
    if saved is not None:
        spark.conf.set(TASK_SIZE_KEY, saved)


def test_layers_bound_a_task_where_the_session_names_no_size(spark, size_conf):
    Layers.from_testdata(spark, "/root/testdata/sf0.001")
    assert size_conf.get(TASK_SIZE_KEY, None) == TASK_SIZE


def test_a_size_of_the_session_stays(spark, size_conf):
    size_conf.set(TASK_SIZE_KEY, "256m")
    ensure_task_size(spark)
    assert size_conf.get(TASK_SIZE_KEY) == "256m"


def test_items_are_dealt_by_order_before_they_are_joined(spark):
    """Rows as before, null and repeated keys included; no distinct runs in the tasks of the scan."""
    orders = spark.createDataFrame([(1, "2018-01-01"), (2, "2018-02-01"), (2, "2018-02-01"), (None, "2018-03-01")],
                                   "o_orderkey long, o_orderdate string").selectExpr("o_orderkey", "cast(o_orderdate as timestamp_ntz) o_orderdate")
    lines = spark.createDataFrame(
        [(1, 5, 7, 1, 10.0), (1, 4, 7, 2, 20.0), (2, 4, 8, 1, 30.0), (None, 4, 8, 1, 30.0), (9, 4, 8, 1, 30.0)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double").selectExpr(
        "*", "1.0D l_quantity", "timestamp_ntz'2018-01-05 00:00:00' l_shipdate", "0.1D l_discount", "0.02D l_tax")
    items = raw_order_items(lines, orders)
    rows = sorted((r.order_id, r.order_item_id, r.product_id, r.seller_id, float(r.price)) for r in items.collect())
    assert rows == [(1, 1, 4, 7, 20.0), (1, 2, 5, 7, 10.0), (2, 1, 4, 8, 30.0), (2, 2, 4, 8, 30.0)]
    plan = items.select("order_id", "seller_id").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert plan.index("HashAggregate") < plan.index("REPARTITION_BY_COL")
