"""Wiring of the layers: raw -> staging -> intermediate -> marts.

Each property builds its DataFrame once and returns the same object on every
later use, so two consumers of one frame share one plan fragment and Spark can
reuse its exchanges. Nothing is executed here.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import intermediate, marts, staging
from mercato.schemas import RAW_TABLE_NAMES
from mercato.session import ensure_task_size
from mercato.sources.store import TableStore
from mercato.sources.testdata import RawTables, raw_tables_from_testdata


class Layers:
    def __init__(self, raw: RawTables):
        self.raw = raw

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        ensure_task_size(spark)
        return cls(raw_tables_from_testdata(spark, sf_dir))

    @classmethod
    def from_raw_dir(cls, spark: SparkSession, raw_dir: str) -> "Layers":
        """Layers over the raw tables published in a store, or kept as plain folders (``<raw_dir>/<table>``)."""
        ensure_task_size(spark)
        held = TableStore(spark, raw_dir).tables()
        if held:
            return cls(RawTables(**{n: held[n].read(spark) for n in RAW_TABLE_NAMES}))
        base = raw_dir.rstrip("/")
        return cls(RawTables(**{n: spark.read.parquet(f"{base}/{n}") for n in RAW_TABLE_NAMES}))

    VIEW_NAMES = (
        "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers",
        "stg_sellers", "stg_products", "stg_geolocation", "stg_category_translation",
        "int_order_items_enriched", "int_orders_aggregated", "int_orders_enriched",
        "fct_orders", "mart_category_performance", "mart_seller_performance",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Register every layer as a temp view under its model name (for SQL users).

        Views are lazy: a SQL query over them plans the whole chain with
        Catalyst like the DataFrame functions do.
        """
        names = []
        for name in self.VIEW_NAMES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    # staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw.order_payments)

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw.order_reviews)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw.geolocation)

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return staging.stg_category_translation(self.raw.category_name_translation)

    # intermediate
    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return intermediate.int_order_items_enriched(
            self.stg_order_items, self.stg_products, self.stg_category_translation, self.stg_sellers)

    @cached_property
    def int_orders_aggregated(self) -> DataFrame:
        return intermediate.int_orders_aggregated(self.int_order_items_enriched)

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return intermediate.int_orders_enriched(
            self.stg_orders, self.stg_customers, self.stg_order_reviews, self.int_orders_aggregated)

    # marts
    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.int_orders_enriched)

    @cached_property
    def mart_category_performance(self) -> DataFrame:
        return marts.mart_category_performance(self.int_order_items_enriched, self.int_orders_enriched)

    @cached_property
    def mart_seller_performance(self) -> DataFrame:
        return marts.mart_seller_from_items(
            self.stg_order_items, self.int_orders_enriched,
            lambda items: intermediate.int_order_items_enriched(
                items, self.stg_products, self.stg_category_translation, self.stg_sellers))
