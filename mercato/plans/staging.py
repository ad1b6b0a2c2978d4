"""Staging: rename, cast and normalise each raw table (no joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import (MONEY, exact_avg, norm_lower, norm_title, norm_upper, to_ts,
                               zip_text)
from mercato.operators import latest_per_key


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id", "customer_id",
        norm_lower("order_status").alias("order_status"),
        to_ts("order_purchase_timestamp").alias("purchased_at"),
        to_ts("order_approved_at").alias("approved_at"),
        to_ts("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        to_ts("order_delivered_customer_date").alias("delivered_to_customer_at"),
        to_ts("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        to_ts("shipping_limit_date").alias("shipping_limit_at"),
        F.col("price").cast(MONEY).alias("item_price"),
        F.col("freight_value").cast(MONEY).alias("item_freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id", "payment_sequential",
        norm_lower("payment_type").alias("payment_type"),
        F.col("payment_installments").cast("bigint").alias("payment_installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """Latest review per order (by answer time; equal times: larger review_id).

    The answer time is cast before ordering, so text input orders by time, not by
    its characters.
    """
    typed = raw.withColumn("review_answer_timestamp", to_ts("review_answer_timestamp"))
    latest = latest_per_key(typed, ["order_id"], ["review_answer_timestamp", "review_id"])
    return latest.select(
        "review_id", "order_id",
        F.col("review_score").cast("bigint").alias("review_score"),
        "review_comment_title", "review_comment_message",
        to_ts("review_creation_date").alias("review_created_at"),
        to_ts("review_answer_timestamp").alias("review_answered_at"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    zdt = raw.schema["customer_zip_code_prefix"].dataType
    return raw.select(
        "customer_id", "customer_unique_id",
        zip_text("customer_zip_code_prefix", zdt).alias("customer_zip_code_prefix"),
        norm_title("customer_city").alias("customer_city"),
        norm_upper("customer_state").alias("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    zdt = raw.schema["seller_zip_code_prefix"].dataType
    return raw.select(
        "seller_id",
        zip_text("seller_zip_code_prefix", zdt).alias("seller_zip_code_prefix"),
        norm_title("seller_city").alias("seller_city"),
        norm_upper("seller_state").alias("seller_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        F.col("product_category_name").alias("product_category_name_pt"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
        .alias("product_volume_cm3"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One centroid per zip prefix; city/state = smallest value (deterministic any_value)."""
    zdt = raw.schema["geolocation_zip_code_prefix"].dataType
    norm = raw.select(
        zip_text("geolocation_zip_code_prefix", zdt).alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
        norm_lower("geolocation_city").alias("city"),
        norm_upper("geolocation_state").alias("state"),
    )
    return norm.groupBy("zip_code_prefix").agg(
        exact_avg("lat").alias("lat"), exact_avg("lng").alias("lng"),
        F.min("city").alias("city"), F.min("state").alias("state"))


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_category_name").alias("category_name_pt"),
        F.col("product_category_name_english").alias("category_name_en"),
    )
