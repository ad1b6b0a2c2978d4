"""The 71 declared data checks of the pipeline (raw 13, staging 46, marts 12)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mercato.operators.quality import (Check, accepted_values, not_null, relationships,
                                       run_checks, unique, unique_combination)
from mercato.plans.layers import Layers
from mercato.sources.testdata import RawTables

# Accepted order statuses, payment types and review scores.
ORDER_STATUSES = ("created", "approved", "invoiced", "processing", "shipped", "delivered",
                  "canceled", "unavailable")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)


def _nn(layer, table, *cols):
    return [not_null(layer, table, c) for c in cols]


RAW_CHECKS: list[Check] = [
    *_nn("raw", "orders", "order_id", "customer_id"),
    *_nn("raw", "order_items", "order_id", "order_item_id"),
    *_nn("raw", "order_payments", "order_id", "payment_sequential"),
    *_nn("raw", "order_reviews", "review_id", "order_id"),
    *_nn("raw", "customers", "customer_id", "customer_unique_id"),
    *_nn("raw", "products", "product_id"),
    *_nn("raw", "sellers", "seller_id"),
    *_nn("raw", "category_name_translation", "product_category_name"),
]

STAGING_CHECKS: list[Check] = [
    unique("staging", "stg_category_translation", "category_name_pt"),
    *_nn("staging", "stg_category_translation", "category_name_pt", "category_name_en"),
    unique("staging", "stg_sellers", "seller_id"),
    *_nn("staging", "stg_sellers", "seller_id", "seller_zip_code_prefix", "seller_state"),
    unique("staging", "stg_customers", "customer_id"),
    *_nn("staging", "stg_customers", "customer_id", "customer_unique_id",
         "customer_zip_code_prefix", "customer_state"),
    unique("staging", "stg_products", "product_id"),
    *_nn("staging", "stg_products", "product_id"),
    unique("staging", "stg_orders", "order_id"),
    *_nn("staging", "stg_orders", "order_id", "customer_id"),
    relationships("staging", "stg_orders", "customer_id", "stg_customers", "customer_id"),
    *_nn("staging", "stg_orders", "order_status"),
    accepted_values("staging", "stg_orders", "order_status", ORDER_STATUSES),
    *_nn("staging", "stg_orders", "purchased_at", "estimated_delivery_at"),
    unique_combination("staging", "stg_order_items", ("order_id", "order_item_id")),
    *_nn("staging", "stg_order_items", "order_id", "order_item_id", "product_id", "seller_id",
         "shipping_limit_at", "item_price", "item_freight_value"),
    unique_combination("staging", "stg_order_payments", ("order_id", "payment_sequential")),
    *_nn("staging", "stg_order_payments", "order_id", "payment_sequential", "payment_type"),
    accepted_values("staging", "stg_order_payments", "payment_type", PAYMENT_TYPES),
    *_nn("staging", "stg_order_payments", "payment_installments", "payment_value"),
    *_nn("staging", "stg_order_reviews", "review_id"),
    unique("staging", "stg_order_reviews", "order_id"),
    *_nn("staging", "stg_order_reviews", "order_id", "review_score"),
    accepted_values("staging", "stg_order_reviews", "review_score", REVIEW_SCORES),
    unique("staging", "stg_geolocation", "zip_code_prefix"),
    *_nn("staging", "stg_geolocation", "zip_code_prefix", "lat", "lng"),
]

MART_CHECKS: list[Check] = [
    unique("marts", "fct_orders", "order_id"),
    *_nn("marts", "fct_orders", "order_id", "customer_unique_id", "order_status", "purchase_month"),
    *_nn("marts", "mart_category_performance", "category", "purchase_year", "purchase_month",
         "total_orders"),
    unique("marts", "mart_seller_performance", "seller_id"),
    *_nn("marts", "mart_seller_performance", "seller_id", "total_orders"),
]

ALL_CHECKS: list[Check] = RAW_CHECKS + STAGING_CHECKS + MART_CHECKS

STAGING_TABLES = ("stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
                  "stg_customers", "stg_sellers", "stg_products", "stg_geolocation",
                  "stg_category_translation")
MART_TABLES = ("fct_orders", "mart_category_performance", "mart_seller_performance")


def check_frames(p: Layers, tables=None) -> dict[str, DataFrame]:
    """Frames by check-table name (raw tables by their raw name); only ``tables`` if given."""
    frames = {n: df for n, df in p.raw.as_dict().items() if tables is None or n in tables}
    frames.update({t: getattr(p, t) for t in STAGING_TABLES + MART_TABLES
                   if tables is None or t in tables})
    return frames


def checks_of_kind(kind: str | None) -> list[Check]:
    return [c for c in ALL_CHECKS if kind is None or c.kind == kind]


def check_report(p: Layers, kind: str | None = None) -> DataFrame:
    checks = checks_of_kind(kind)
    tables = {c.table for c in checks} | {c.parent[0] for c in checks if c.parent}
    return run_checks(check_frames(p, tables), checks)


def damaged_report(p: Layers) -> DataFrame:
    """The staging checks of orders and items over input with known faults, so that every kind fires.

    Of the orders, every 7th has an unknown status, every 11th no customer, every 17th a customer that
    does not exist, and every 13th comes twice; the items of every 5th order come twice.
    """
    o, i = p.raw.orders, p.raw.order_items
    orders = o.selectExpr(
        "order_id",
        "case when order_id % 11 = 0 then null when order_id % 17 = 0 then -order_id else customer_id end as customer_id",
        "case when order_id % 7 = 0 then 'lost' else order_status end as order_status",
        *[c for c in o.columns if c not in ("order_id", "customer_id", "order_status")])
    raw = p.raw.as_dict() | {"orders": orders.unionByName(orders.where("order_id % 13 = 0")),
                             "order_items": i.unionByName(i.where("order_id % 5 = 0"))}
    checks = [c for c in STAGING_CHECKS if c.table in ("stg_orders", "stg_order_items")]
    return run_checks(check_frames(Layers(RawTables(**raw)), {"stg_orders", "stg_order_items", "stg_customers"}), checks)
