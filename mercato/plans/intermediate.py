"""Intermediate layer: item enrichment, per-order aggregates, order enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import (MONEY, day_diff, exact_avg, exact_sum, money_sum, round_half_up, safe_div)


def int_order_items_enriched(items: DataFrame, products: DataFrame,
                             translation: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items + product attributes + English category + seller location.

    All three are joined by key and left to Spark's size threshold (broadcast
    when small, shuffle otherwise). Categories are translated at the products,
    so items move for products and sellers only. The items' own columns, some
    or all of the staged ones, come first.
    """
    translated = products.alias("p").join(
        translation.alias("ct"), F.col("p.product_category_name_pt") == F.col("ct.category_name_pt"), "left").select("p.*", "ct.category_name_en")
    joined = (items.alias("oi")
              .join(translated.alias("p"), "product_id", "left")
              .join(sellers.alias("s"), "seller_id", "left"))
    return joined.select(
        *items.columns,
        (F.col("item_price") + F.col("item_freight_value")).cast(MONEY).alias("item_gross_value"),
        (safe_div("item_freight_value", "item_price") * F.lit(100.0)).alias("item_freight_ratio_pct"),
        "p.product_category_name_pt",
        F.coalesce(F.col("p.category_name_en"), F.lit("uncategorized")).alias("product_category_name_en"),
        "p.product_weight_g", "p.product_volume_cm3", "p.product_photos_qty",
        "p.product_name_length", "p.product_description_length",
        "s.seller_city", "s.seller_state", "s.seller_zip_code_prefix",
    )


def int_orders_aggregated(items_enriched: DataFrame) -> DataFrame:
    """One row per order that has items."""
    return items_enriched.groupBy("order_id").agg(
        F.count("order_item_id").alias("items_count"),
        F.countDistinct("seller_id").alias("sellers_count"),
        F.countDistinct("product_category_name_en").alias("categories_count"),
        money_sum("item_price").alias("order_revenue"),
        money_sum("item_freight_value").alias("order_freight_value"),
        money_sum("item_gross_value").alias("order_gross_value"),
        round_half_up(safe_div(F.sum("item_freight_value"), F.sum("item_price")) * F.lit(100.0), 2)
        .alias("order_freight_ratio_pct"),
        exact_sum("product_weight_g").alias("order_total_weight_g"),
        round_half_up(exact_avg("product_photos_qty"), 1).alias("avg_photos_qty"),
        round_half_up(exact_avg("product_name_length"), 1).alias("avg_name_length"),
        round_half_up(exact_avg("product_description_length"), 1).alias("avg_description_length"),
    )


def int_orders_enriched(orders: DataFrame, customers: DataFrame, reviews: DataFrame,
                        order_aggregates: DataFrame) -> DataFrame:
    """Orders + customer + latest review + item aggregates, plus time metrics and flags."""
    o = (orders.join(customers, "customer_id", "left")
         .join(reviews.select("order_id", "review_score", "review_created_at", "review_answered_at"),
               "order_id", "left")
         .join(order_aggregates, "order_id", "left"))
    delivered, estimated = F.col("delivered_to_customer_at"), F.col("estimated_delivery_at")
    purchased = F.col("purchased_at")
    return o.select(
        "order_id", "customer_id", "customer_unique_id",
        "order_status", "purchased_at", "approved_at", "delivered_to_carrier_at",
        "delivered_to_customer_at", "estimated_delivery_at",
        "customer_city", "customer_state", "customer_zip_code_prefix",
        day_diff(delivered, purchased).alias("days_to_deliver"),
        day_diff(estimated, purchased).alias("days_promised"),
        day_diff(delivered, estimated).alias("delivery_delay_days"),
        day_diff("approved_at", purchased).alias("days_to_approve"),
        day_diff("delivered_to_carrier_at", "approved_at").alias("days_to_ship"),
        (delivered.isNotNull() & (delivered > estimated)).alias("is_late"),
        (F.col("order_status") == "delivered").alias("is_delivered"),
        (F.col("order_status") == "canceled").alias("is_canceled"),
        F.trunc(F.to_date(purchased), "month").alias("purchase_month"),
        F.year(purchased).cast("bigint").alias("purchase_year"),
        F.month(purchased).cast("bigint").alias("purchase_month_num"),
        F.dayofweek(purchased).cast("bigint").alias("purchase_day_of_week"),
        "review_score", "review_created_at", "review_answered_at",
        (F.col("review_score") >= 4).alias("is_positive_review"),
        (F.col("review_score") <= 2).alias("is_negative_review"),
        "items_count", "sellers_count", "categories_count", "order_revenue",
        "order_freight_value", "order_gross_value", "order_freight_ratio_pct",
        "order_total_weight_g", "avg_photos_qty", "avg_name_length", "avg_description_length",
    )
