"""Build: checks on raw + staging gate the marts; marts are written once, checked, and published together.

The analyses then read the stored marts (as the reference's queries read its
mart tables) instead of recomputing the whole chain each time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mercato.operators.quality import assert_passed, run_checks
from mercato.plans.checks import MART_CHECKS, RAW_CHECKS, STAGING_CHECKS, check_frames
from mercato.plans import intermediate as I
from mercato.plans import marts as M
from mercato.schemas import RAW_TABLE_NAMES
from mercato.plans.layers import Layers
from mercato.sources.store import TableStore

# Stored tables and their partition columns.
STORED = {
    "int_order_items_enriched": None,
    "fct_orders": ["purchase_month"],
    "delivered_lines": None,
    "mart_category_performance": ["purchase_year"],
    "mart_seller_performance": None,
}


@dataclass
class Marts:
    items_enriched: DataFrame
    fct_orders: DataFrame
    mart_category_performance: DataFrame
    mart_seller_performance: DataFrame


def store_raw(spark: SparkSession, layers: Layers, raw_dir: str) -> Layers:
    """Load the nine raw tables into their store (the warehouse's raw layer); return layers over them."""
    load = TableStore(spark, raw_dir).load()
    for name in RAW_TABLE_NAMES:
        load.write(name, getattr(layers.raw, name))
    load.publish()
    return Layers.from_raw_dir(spark, raw_dir)


def build_marts(spark: SparkSession, layers: Layers, target_dir: str, *, gate: bool = True) -> Marts:
    """Check raw + staging (raise on failure), write the stored tables, check the marts, publish them.

    The two fact tables are written first; both marts are then computed from
    the stored facts (the order fact carries every order column they read), so
    no layer is computed twice and the written tables cut the lineage. All tables take
    the place of the previous build's at once; a build that fails changes nothing.
    """
    if gate:  # a failing layer stops everything after it
        frames = check_frames(layers)
        assert_passed(run_checks(frames, RAW_CHECKS))
        assert_passed(run_checks(frames, STAGING_CHECKS))
    load = TableStore(spark, target_dir).load()

    def stored(name: str, df: DataFrame) -> DataFrame:
        return load.write(name, df, partition_by=STORED[name])

    items = stored("int_order_items_enriched", layers.int_order_items_enriched)
    orders = I.int_orders_enriched(layers.stg_orders, layers.stg_customers, layers.stg_order_reviews,
                                   I.int_orders_aggregated(items))
    fct = stored("fct_orders", M.fct_orders(orders))
    # one join of items and delivered orders, written once, feeds both marts
    lines = stored("delivered_lines", M.delivered_item_lines(items, fct))
    category = stored("mart_category_performance", M.mart_category_from_lines(lines))
    seller = stored("mart_seller_performance", M.mart_seller_from_lines(lines))
    if gate:
        marts = {"fct_orders": fct, "mart_category_performance": category, "mart_seller_performance": seller}
        assert_passed(run_checks(marts, MART_CHECKS))
    load.publish()
    return Marts(items, fct, category, seller)


def open_marts(spark: SparkSession, target_dir: str) -> Marts:
    """The marts of the last build that was published."""
    tables = TableStore(spark, target_dir).tables()
    names = ("int_order_items_enriched", "fct_orders", "mart_category_performance", "mart_seller_performance")
    return Marts(*[tables[n].read(spark) for n in names])
