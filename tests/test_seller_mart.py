"""The seller mart over items: the rows of the mart over enriched lines, from one reading of items and orders."""

import re

import pytest

from mercato.plans import marts as M
from mercato.plans.layers import Layers
from mercato.sources.testdata import raw_order_items
from tests.helpers import DEFAULTS, item, make_raw, order, review

ODD = {
    "orders": [order(1), order(2, customer_id=2), order(3, status="shipped"), order(4, delivered=None, status="delivered"), order(5), order(5),
               order(6, customer_id=None), order(None), order(7, delivered="2018-01-29 10:00:00")],
    "order_items": [item(1, 1), item(1, 2), item(1, 2), item(1, 3, product_id=51, price=30), item(2, 1, seller_id=11, price="0.01"), item(2, 2, seller_id=None),
                    item(2, 3, seller_id=None, product_id=None), item(3, 1, seller_id=12), item(4, 1, product_id=None, price=7), item(4, 2, product_id=99),
                    item(5, 1, seller_id=12, freight=3), item(5, 2, seller_id=99), item(6, 1, product_id=52), item(None, 1), item(7, 1, seller_id=11), item(8, 1)],
    "products": [*DEFAULTS["products"], (50, "moveis", *DEFAULTS["products"][0][2:]), (52, None, *DEFAULTS["products"][0][2:])],
    "category_name_translation": [*DEFAULTS["category_name_translation"], ("cama", "bedding")],
    "sellers": [*DEFAULTS["sellers"], DEFAULTS["sellers"][0], (11, "30000", "contagem", "mg"), (12, None, None, None)],
    "customers": [*DEFAULTS["customers"], DEFAULTS["customers"][1]],
    "order_reviews": [review(1, 1, 5), review(2, 1, 1, answered="2018-01-26 00:00:00"), review(3, 2, 4), review(4, 5, 2)],
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_rows_as_over_enriched_lines(spark):
    """Repeated and null keys of every table count as they do where each line is enriched first."""
    p = Layers(make_raw(spark, **ODD))
    lines = M.mart_seller_performance(p.int_order_items_enriched, p.int_orders_enriched)
    assert p.mart_seller_performance.dtypes == lines.dtypes
    got = rows(p.mart_seller_performance)
    assert got == rows(lines) and len(got) == 6
    none = next(r for r in got if r[0] is None)
    assert none[3] == 1 and none[4] is None and none[5] is None and none[7] is None and none[6] is not None


def test_no_items_and_a_price_of_null(spark):
    assert Layers(make_raw(spark, orders=[order(1)])).mart_seller_performance.count() == 0
    unpriced = [(1, 1, 50, 10, "2018-01-12 00:00:00", None, None)]
    p = Layers(make_raw(spark, orders=[order(1)], order_items=unpriced))
    assert rows(p.mart_seller_performance) == rows(M.mart_seller_performance(p.int_order_items_enriched, p.int_orders_enriched))
    got = p.mart_seller_performance.first()
    assert (got.total_orders, got.unique_products, got.seller_revenue, got.avg_item_price) == (1, 1, None, None)


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, saved)


def test_items_and_orders_are_shuffled_once(spark, no_broadcast):
    """Where no table is broadcast, items move by product and by seller once, and all that lies under both uses is shared."""
    mart = Layers(make_raw(spark, **ODD)).mart_seller_performance
    mart.collect()
    plan = mart._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    moved = [m[1] for line in plan.splitlines() if "ReusedExchange" not in line and (m := re.search(r"Exchange hashpartitioning\((\w+)", line))]
    assert moved.count("product_id") == 2 and moved.count("product_category_name_pt") == 1
    assert moved.count("seller_id") <= 3 and moved.count("order_id") <= 3 and len(moved) <= 14
    assert "ReusedExchange" in plan


def test_categories_are_translated_at_the_products(spark, no_broadcast):
    p = Layers(make_raw(spark, **ODD))
    plan = p.int_order_items_enriched._jdf.queryExecution().executedPlan().toString()
    assert plan.index("[seller_id") < plan.index("[product_id") < plan.index("[product_category_name_pt")
    below = plan[: plan.index("[product_category_name_pt")]
    assert below.count("SortMergeJoin") == 3 and "item_price" in below


def test_prices_move_as_whole_numbers(spark):
    orders = spark.createDataFrame([(1, "2018-01-01")], "o_orderkey long, o_orderdate string").selectExpr("o_orderkey", "cast(o_orderdate as timestamp_ntz) o_orderdate")
    lines = spark.createDataFrame([(1, 4, 7, 1, 10.005), (1, 4, 7, 2, None)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double").selectExpr(
        "*", "1.0D l_quantity", "timestamp_ntz'2018-01-05 00:00:00' l_shipdate", "0.1D l_discount", "0.02D l_tax")
    items = raw_order_items(lines, orders)
    assert [(r.order_item_id, r.price is None or float(r.price), r.freight_value is None or float(r.freight_value)) for r in items.orderBy("order_item_id").collect()] == [(1, 10.01, 3.0), (2, True, True)]
    plan = items.select("order_id", "price", "freight_value")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression") < plan.index("l_extendedprice")
