"""Marts: order fact, category x month performance, seller performance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import MONEY_SUM, avg_money, exact_avg, money_sum, rate_pct, round_half_up

FCT_ORDERS_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id",
    "order_status", "is_delivered", "is_canceled",
    "customer_state", "customer_city", "customer_zip_code_prefix",
    "purchased_at", "approved_at", "delivered_to_carrier_at", "delivered_to_customer_at",
    "estimated_delivery_at",
    "purchase_month", "purchase_year", "purchase_month_num", "purchase_day_of_week",
    "days_to_deliver", "days_promised", "delivery_delay_days", "days_to_approve", "days_to_ship",
    "is_late",
    "review_score", "is_positive_review", "is_negative_review",
    "items_count", "sellers_count", "order_revenue", "order_freight_value", "order_gross_value",
    "order_freight_ratio_pct", "order_total_weight_g",
]


def fct_orders(orders_enriched: DataFrame) -> DataFrame:
    return orders_enriched.select(*FCT_ORDERS_COLUMNS)


def _delivered(orders_enriched: DataFrame, cols) -> DataFrame:
    return orders_enriched.where(F.col("order_status") == "delivered").select("order_id", *cols)


LINE_ITEM_COLUMNS = ("order_id", "order_item_id", "product_id", "seller_id", "seller_state",
                     "seller_city", "product_category_name_en", "item_price", "item_gross_value",
                     "item_freight_ratio_pct", "product_weight_g")
LINE_ORDER_COLUMNS = ("review_score", "is_late", "days_to_deliver", "delivery_delay_days",
                      "purchased_at", "purchase_month", "purchase_year")


def delivered_item_lines(items_enriched: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    """Items of delivered orders with the order attributes both marts read.

    One join on ``order_id``. ``build_marts`` persists it so both marts (four
    aggregation branches) share a single shuffle of the item fact, and the
    order-grain aggregates reuse its ``order_id`` partitioning.
    """
    return (items_enriched.select(*LINE_ITEM_COLUMNS)
            .join(_delivered(orders_enriched, LINE_ORDER_COLUMNS), "order_id"))


def mart_category_performance(items_enriched: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    return mart_category_from_lines(delivered_item_lines(items_enriched, orders_enriched))


def mart_seller_performance(items_enriched: DataFrame, orders_enriched: DataFrame) -> DataFrame:
    return mart_seller_from_lines(delivered_item_lines(items_enriched, orders_enriched))


def mart_category_from_lines(lines: DataFrame) -> DataFrame:
    """Grain (category, purchase year, purchase month) over delivered orders.

    Level 1 collapses items to (category, month, order) so an order counts once
    per category; it groups by a superset of the join key, so it needs no new
    shuffle. Level 2 rolls up to the mart grain with partial aggregation and
    meets the distinct-seller count on the same three keys.
    """
    keys = ["category", "purchase_year", "purchase_month"]
    j = lines.withColumnRenamed("product_category_name_en", "category")
    basket = j.groupBy(*keys, "order_id").agg(
        F.any_value("review_score").alias("review_score"),
        F.any_value("is_late").alias("is_late"),
        F.sum("item_price").alias("revenue"),
        F.sum("item_gross_value").alias("gross_value"),
        avg_money("item_price").alias("mean_price"),
        exact_avg("item_freight_ratio_pct").alias("mean_freight_ratio"),
        exact_avg("product_weight_g").alias("mean_weight"),
    )
    sellers = j.groupBy(*keys).agg(F.countDistinct("seller_id").alias("active_sellers"))
    rolled = basket.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("revenue").alias("category_revenue"),
        round_half_up(exact_avg("mean_price"), 2).alias("avg_item_price"),
        money_sum("gross_value").alias("category_gross_value"),
        round_half_up(exact_avg("mean_freight_ratio"), 2).alias("avg_freight_ratio_pct"),
        round_half_up(exact_avg("mean_weight"), 1).alias("avg_product_weight_g"),
        round_half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        F.count_if(F.col("review_score") >= 4).alias("positive_reviews"),
        F.count_if(F.col("review_score") <= 2).alias("negative_reviews"),
        F.count_if("is_late").alias("late_orders"),
    )
    return rolled.join(sellers, keys, "left").select(
        *keys, "total_orders", "active_sellers", "category_revenue", "avg_item_price",
        "category_gross_value", "avg_freight_ratio_pct", "avg_product_weight_g",
        "avg_review_score", "positive_reviews", "negative_reviews", "late_orders")


ORDER_ATTRS = ("review_score", "is_late", "days_to_deliver", "delivery_delay_days", "purchased_at")


def mart_seller_from_lines(lines: DataFrame) -> DataFrame:
    """One row per seller over delivered orders (all time).

    Seller state and city depend on the seller, so they are grouping columns
    rather than string any_value buffers (which would force sort-based
    aggregation); order attributes depend on the order (fixed-width any_value).
    """
    who = ["seller_id", "seller_state", "seller_city"]
    sales = lines.groupBy(*who, "order_id").agg(
        *[F.any_value(c).alias(c) for c in ORDER_ATTRS],
        F.sum("item_price").alias("revenue"),
        F.sum("item_gross_value").alias("gross_value"),
    )
    # items collapse to (product, category) first; then one distinct an aggregate, so no rows are doubled
    by_product = lines.groupBy("seller_id", "product_id", "product_category_name_en").agg(
        F.sum("item_price").alias("price"),
        F.count("item_price").alias("priced"))
    catalog = by_product.groupBy("seller_id").agg(
        F.countDistinct("product_category_name_en").alias("unique_categories"),
        round_half_up(F.sum("price").cast("double") / F.nullif(F.sum("priced"), F.lit(0)), 2).alias("avg_item_price"),
    )
    products = by_product.groupBy("seller_id").agg(F.countDistinct("product_id").alias("unique_products"))
    per_seller = sales.groupBy(*who).agg(
        money_sum("revenue").alias("seller_revenue"),
        money_sum("gross_value").alias("seller_gross_value"),
        *_order_measures(),
    )
    return per_seller.join(catalog, "seller_id", "left").join(products, "seller_id", "left").select(*SELLER_COLUMNS)


SELLER_COLUMNS = (
    "seller_id", "seller_state", "seller_city", "total_orders", "unique_products",
    "unique_categories", "seller_revenue", "avg_item_price", "seller_gross_value",
    "avg_days_to_deliver", "avg_delay_days", "late_orders", "pct_late_orders",
    "avg_review_score", "positive_reviews", "negative_reviews", "first_sale_date",
    "last_sale_date")


def _order_measures() -> list[Column]:
    """What a seller's orders, one row each, amount to."""
    return [
        F.count(F.lit(1)).alias("total_orders"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_to_deliver"),
        round_half_up(F.avg("delivery_delay_days"), 1).alias("avg_delay_days"),
        F.count_if("is_late").alias("late_orders"),
        rate_pct("is_late").alias("pct_late_orders"),
        round_half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        F.count_if(F.col("review_score") >= 4).alias("positive_reviews"),
        F.count_if(F.col("review_score") <= 2).alias("negative_reviews"),
        F.min(F.to_date("purchased_at")).alias("first_sale_date"),
        F.max(F.to_date("purchased_at")).alias("last_sale_date"),
    ]


def mart_seller_from_items(items: DataFrame, orders_enriched: DataFrame, enriched: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The seller mart over items that ``enriched`` gives their product and seller attributes.

    The order filter comes first, where the items still lie by order, so undelivered items are not enriched.
    Order attributes stay there: a seller's orders are counted before any item moves. Items move without
    them, by product and by seller, and every sum and count of a seller is then where its items are.
    """
    lines = items.select("order_id", "product_id", "seller_id", "item_price", "item_freight_value").join(_delivered(orders_enriched, ORDER_ATTRS), "order_id")
    # Equal lines as one with their number. Grouped by all columns, and with a number that both uses read, neither
    # use can leave out a column, so both read the same shuffles of items and orders.
    lines = lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 0")
    orders = lines.groupBy("seller_id", "order_id").agg(*[F.any_value(c).alias(c) for c in ORDER_ATTRS])
    orders = orders.groupBy(F.col("seller_id").alias("orders_of")).agg(*_order_measures())

    who = ["seller_id", "seller_state", "seller_city"]
    sold = enriched(lines.drop(*ORDER_ATTRS))
    by_product = sold.groupBy(*who, "product_id", "product_category_name_en").agg(
        F.sum(F.col("item_price") * F.col("copies")).alias("price"),
        F.sum(F.when(F.col("item_price").isNotNull(), F.col("copies")).otherwise(F.lit(0))).alias("priced"),
        F.sum(F.col("item_gross_value") * F.col("copies")).alias("gross_value"))
    # a product under several categories counts once: in the row of the first of them
    first = F.row_number().over(Window.partitionBy(*who, "product_id").orderBy("product_category_name_en"))
    known = F.col("seller_id").isNotNull()
    by_seller = by_product.withColumn("first", (first == 1) & F.col("product_id").isNotNull()).groupBy(*who).agg(
        F.count_if("first").alias("unique_products"),
        F.countDistinct("product_category_name_en").alias("unique_categories"),
        F.sum("price").cast(MONEY_SUM).alias("seller_revenue"),
        F.sum("gross_value").cast(MONEY_SUM).alias("seller_gross_value"),
        round_half_up(F.sum("price").cast("double") / F.nullif(F.sum("priced"), F.lit(0)), 2).alias("avg_item_price"))
    # items without a seller have no catalog
    by_seller = by_seller.withColumns({c: F.when(known, F.col(c)) for c in ("unique_products", "unique_categories", "avg_item_price")})
    return by_seller.join(orders, F.col("seller_id").eqNullSafe(F.col("orders_of"))).select(*SELLER_COLUMNS)
