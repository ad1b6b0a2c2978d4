"""Hand-made cases for the rules of the intermediate layer, marts and analyses."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from mercato.plans import analyses as A
from mercato.plans.extensions import ext_route_distance
from mercato.plans.layers import Layers
from tests.helpers import item, make_raw, order, review


def layers(spark, **t):
    return Layers(make_raw(spark, **t))


def test_order_without_items_kept_in_fact_absent_from_marts(spark):
    p = layers(spark, orders=[order(1), order(2)], order_items=[item(1, 1)])
    fct = {r.order_id: r for r in p.fct_orders.collect()}
    assert fct[2].items_count is None and fct[2].order_revenue is None
    assert fct[1].items_count == 1 and fct[1].order_revenue == Decimal("100.00")
    assert p.mart_category_performance.agg(F.sum("total_orders")).first()[0] == 1
    assert p.mart_seller_performance.agg(F.sum("total_orders")).first()[0] == 1


def test_zero_price_gives_null_ratios(spark):
    p = layers(spark, orders=[order(1)], order_items=[item(1, 1, price=0, freight=5)])
    assert p.int_order_items_enriched.first().item_freight_ratio_pct is None
    assert p.fct_orders.first().order_freight_ratio_pct is None
    assert A.freight_bucket_satisfaction(p.fct_orders).count() == 0


def test_undelivered_order_not_late_and_no_day_counts(spark):
    p = layers(spark, orders=[order(1, status="shipped", delivered=None)])
    r = p.fct_orders.first()
    assert r.is_late is False
    assert r.days_to_deliver is None and r.delivery_delay_days is None
    assert r.days_promised == 10


def test_late_on_promised_day_has_zero_delay(spark):
    p = layers(spark, orders=[order(1, delivered="2018-01-20 15:00:00", estimated="2018-01-20 09:00:00")])
    r = p.fct_orders.first()
    assert r.is_late is True and r.delivery_delay_days == 0


def test_review_dedupe_latest_then_larger_id(spark):
    reviews = [review(1, 1, 1, answered="2018-01-25 00:00:00"),
               review(2, 1, 5, answered="2018-01-26 00:00:00"),
               review(3, 2, 2, answered="2018-01-25 00:00:00"),
               review(4, 2, 4, answered="2018-01-25 00:00:00")]
    p = layers(spark, orders=[order(1), order(2)], order_reviews=reviews)
    got = {r.order_id: (r.review_id, r.review_score) for r in p.stg_order_reviews.collect()}
    assert got == {1: (2, 5), 2: (4, 4)}


def test_category_null_or_untranslated_is_uncategorized(spark):
    products = [(50, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
                (51, "sem_traducao", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    p = layers(spark, orders=[order(1)], products=products,
               order_items=[item(1, 1, product_id=50), item(1, 2, product_id=51)])
    cats = {r.product_category_name_en for r in p.int_order_items_enriched.collect()}
    assert cats == {"uncategorized"}


def test_q01_counts_one_order_twice_when_weights_differ(spark):
    products = [(50, "cama", 1.0, 1.0, 1.0, 100.0, 1.0, 1.0, 1.0),
                (51, "cama", 1.0, 1.0, 1.0, 200.0, 1.0, 1.0, 1.0)]
    p = layers(spark, products=products,
               orders=[order(1, delivered="2018-01-25 00:00:00")],
               order_items=[item(1, 1, product_id=50), item(1, 2, product_id=51)])
    r = A.late_rate_by_category(p.int_order_items_enriched, p.int_orders_enriched, min_orders=1).first()
    assert (r.total_orders, r.late_orders, r.pct_late) == (1, 2, 200.0)


def test_two_sellers_same_state_one_route_row(spark):
    sellers = [(10, "01001", "a", "sp"), (11, "01002", "b", "sp")]
    p = layers(spark, sellers=sellers, orders=[order(1)],
               order_items=[item(1, 1, seller_id=10), item(1, 2, seller_id=11)])
    rows = A.late_by_route(p.int_order_items_enriched, p.fct_orders, min_orders=1).collect()
    assert len(rows) == 1 and rows[0].total_orders == 1 and rows[0].intrastate == 1


def test_freight_ratio_exactly_five_goes_to_second_bucket(spark):
    p = layers(spark, orders=[order(1)], order_items=[item(1, 1, price=100, freight=5)],
               order_reviews=[review(1, 1, 5)])
    r = A.freight_bucket_satisfaction(p.fct_orders).first()
    assert r.freight_ratio_bucket == "5-10%"


def test_ten_sellers_have_empty_top_cuts(spark):
    rows = [(i, "sp", "x", 1, 1, 1, Decimal(100 * i), 1.0, Decimal(100 * i), 1.0, 0.0, 0, 0.0, 4.0,
             1, 0, datetime.date(2018, 1, 1), datetime.date(2018, 2, 1)) for i in range(1, 11)]
    cols = ["seller_id", "seller_state", "seller_city", "total_orders", "unique_products",
            "unique_categories", "seller_revenue", "avg_item_price", "seller_gross_value",
            "avg_days_to_deliver", "avg_delay_days", "late_orders", "pct_late_orders",
            "avg_review_score", "positive_reviews", "negative_reviews", "first_sale_date",
            "last_sale_date"]
    mart = spark.createDataFrame(rows, cols).withColumn("seller_revenue", F.col("seller_revenue").cast("decimal(38,2)"))
    got = {r.faixa: (r.receita_acumulada_pct, r.qtd_sellers) for r in A.revenue_pareto(mart).collect()}
    assert got["top 1%"] == (None, 0) and got["top 5%"] == (None, 0)
    assert got["top 10%"] == (round(1000 / 5500 * 100, 2), 1)
    assert got["top 100%"] == (100.0, 10)


def test_canceled_plus_delivered_is_not_repeat(spark):
    customers = [(1, 100, "01001", "x", "sp"), (2, 100, "01001", "x", "sp")]
    p = layers(spark, customers=customers,
               orders=[order(1, customer_id=1), order(2, customer_id=2, status="canceled", delivered=None)])
    r = A.cohort_repurchase(p.fct_orders).first()
    assert (r.cohort_size, r.recompradores) == (1, 0)


def test_null_dimension_gives_null_volume(spark):
    products = [(50, "cama", 1.0, 1.0, 1.0, 1.0, None, 2.0, 3.0)]
    p = layers(spark, products=products)
    assert p.stg_products.first().product_volume_cm3 is None


def test_staging_normalisation(spark):
    p = layers(spark, orders=[order(1, status=" Delivered ")],
               customers=[(1, 100, "01001", "  sao paulo ", " sp")])
    o, c = p.stg_orders.first(), p.stg_customers.first()
    assert o.order_status == "delivered"
    assert (c.customer_city, c.customer_state) == ("Sao Paulo", "SP")


def test_routes_without_a_centroid_are_counted_as_unknown(spark):
    p = layers(spark, orders=[order(1), order(2, customer_id=2)], order_items=[item(1, 1), item(2, 1)],
                     geolocation=[("01001", -23.5, -46.6, "sao paulo", "sp")])
    rows = ext_route_distance(p.int_order_items_enriched, p.fct_orders, p.stg_geolocation).collect()
    assert [(r.distance_band, r.routes) for r in rows] == [("0-25km", 1), ("unknown", 1)]
    assert rows[1].avg_distance_km is None


def test_product_under_two_categories_counts_once(spark):
    """The seller mart counts products, not (product, category) pairs, also where no check ran before it."""
    from mercato.plans.marts import mart_seller_from_lines
    rows = [(1, 1, 50, 10, "SP", "X", "bed", 100), (1, 2, 50, 10, "SP", "X", "bath", 50), (2, 1, 51, 10, "SP", "X", "bed", 30)]
    lines = spark.createDataFrame(rows, "order_id long, order_item_id long, product_id long, seller_id long, seller_state string, seller_city string, product_category_name_en string, p int")
    lines = lines.select("*", F.col("p").cast("decimal(18,2)").alias("item_price"), F.col("p").cast("decimal(18,2)").alias("item_gross_value"),
                         F.lit(5).alias("review_score"), F.lit(False).alias("is_late"), F.lit(3).alias("days_to_deliver"), F.lit(-1).alias("delivery_delay_days"),
                         F.lit("2018-01-01").cast("timestamp_ntz").alias("purchased_at"))
    got = mart_seller_from_lines(lines).first()
    assert (got.unique_products, got.unique_categories, got.total_orders, got.avg_item_price) == (2, 2, 2, 60.0)
