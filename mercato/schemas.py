"""Explicit schemas of the nine raw marketplace tables (no inference).

Ids are text in the source files; ``raw_schema(name, id_type="bigint")`` gives
the same layout with integer ids (the synthetic test tables use integers).
Timestamps arrive as text and are cast in staging.
"""

from __future__ import annotations

from pyspark.sql.types import (DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType)

S, L, D, M = StringType(), LongType(), DoubleType(), DecimalType(18, 2)
ID = "__id__"

# Column layout per raw table: (column, type or ID, nullable)
RAW_COLUMNS: dict[str, list[tuple]] = {
    "orders": [
        ("order_id", ID, False), ("customer_id", ID, False), ("order_status", S, True),
        ("order_purchase_timestamp", S, True), ("order_approved_at", S, True),
        ("order_delivered_carrier_date", S, True), ("order_delivered_customer_date", S, True),
        ("order_estimated_delivery_date", S, True),
    ],
    "order_items": [
        ("order_id", ID, False), ("order_item_id", L, False), ("product_id", ID, True),
        ("seller_id", ID, True), ("shipping_limit_date", S, True), ("price", M, True),
        ("freight_value", M, True),
    ],
    "order_payments": [
        ("order_id", ID, False), ("payment_sequential", L, False), ("payment_type", S, True),
        ("payment_installments", L, True), ("payment_value", M, True),
    ],
    "order_reviews": [
        ("review_id", ID, False), ("order_id", ID, False), ("review_score", L, True),
        ("review_comment_title", S, True), ("review_comment_message", S, True),
        ("review_creation_date", S, True), ("review_answer_timestamp", S, True),
    ],
    "customers": [
        ("customer_id", ID, False), ("customer_unique_id", ID, False),
        ("customer_zip_code_prefix", S, True), ("customer_city", S, True),
        ("customer_state", S, True),
    ],
    "products": [
        ("product_id", ID, False), ("product_category_name", S, True),
        ("product_name_lenght", D, True), ("product_description_lenght", D, True),
        ("product_photos_qty", D, True), ("product_weight_g", D, True),
        ("product_length_cm", D, True), ("product_height_cm", D, True),
        ("product_width_cm", D, True),
    ],
    "sellers": [
        ("seller_id", ID, False), ("seller_zip_code_prefix", S, True),
        ("seller_city", S, True), ("seller_state", S, True),
    ],
    "geolocation": [
        ("geolocation_zip_code_prefix", S, True), ("geolocation_lat", D, True),
        ("geolocation_lng", D, True), ("geolocation_city", S, True),
        ("geolocation_state", S, True),
    ],
    "category_name_translation": [
        ("product_category_name", S, False), ("product_category_name_english", S, True),
    ],
}

RAW_TABLE_NAMES = tuple(RAW_COLUMNS)


def raw_schema(name: str, id_type: str = "string") -> StructType:
    idt = L if id_type in ("bigint", "long") else S
    return StructType([
        StructField(col, idt if typ == ID else typ, True)
        for col, typ, _ in RAW_COLUMNS[name]
    ])
