"""Registry of every query/operator key: ``key -> (spark, sf_dir) -> DataFrame``.

Each callable derives the raw tables from the synthetic test tables in
``sf_dir`` and runs the whole chain lazily; parameters are the ones the oracle
uses (see ``mercato.testing.oracle_queries``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import analyses as A
from mercato.plans import extensions as X
from mercato.plans.checks import check_report, damaged_report
from mercato.plans.generic import GENERIC
from mercato.plans.io_keys import IO_KEYS
from mercato.plans.layers import Layers
from mercato.sources.testdata import FOCUS_STATE, SEASON_YEARS

QueryFn = Callable[[SparkSession, str], DataFrame]


def _layer(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Layers.from_testdata(spark, sf_dir), name)
    run.__name__ = name
    return run


def _on(fn: Callable[[Layers], DataFrame], name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers.from_testdata(spark, sf_dir))
    run.__name__ = name
    return run


LAYER_KEYS = [
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers",
    "stg_sellers", "stg_products", "stg_geolocation", "stg_category_translation",
    "int_order_items_enriched", "int_orders_aggregated", "int_orders_enriched",
    "fct_orders", "mart_category_performance", "mart_seller_performance",
]

ANALYSES: dict[str, Callable[[Layers], DataFrame]] = {
    "late_rate_by_category": lambda p: A.late_rate_by_category(p.int_order_items_enriched,
                                                               p.int_orders_enriched),
    "promised_vs_actual": lambda p: A.promised_vs_actual(p.fct_orders),
    "late_by_route": lambda p: A.late_by_route(p.int_order_items_enriched, p.fct_orders),
    "category_quadrants": lambda p: A.category_quadrants(p.mart_category_performance),
    "freight_bucket_satisfaction": lambda p: A.freight_bucket_satisfaction(p.fct_orders),
    "seasonality_by_category": lambda p: A.seasonality_by_category(p.mart_category_performance,
                                                                   years=SEASON_YEARS),
    "region_comparison": lambda p: A.region_comparison(p.mart_seller_performance, focus=FOCUS_STATE),
    "revenue_pareto": lambda p: A.revenue_pareto(p.mart_seller_performance),
    "pareto_curve": lambda p: A.pareto_curve(p.mart_seller_performance),
    "volume_quality_quintiles": lambda p: A.volume_quality_quintiles(p.mart_seller_performance),
    "cohort_repurchase": lambda p: A.cohort_repurchase(p.fct_orders),
    "repeat_vs_new": lambda p: A.repeat_vs_new(p.fct_orders),
    "satisfaction_by_state": lambda p: A.satisfaction_by_state(p.fct_orders),
}


CHECK_KEYS = {
    "dq_not_null": "not_null", "dq_unique": "unique", "dq_accepted_values": "accepted_values",
    "dq_relationships": "relationships", "dq_unique_combination": "unique_combination",
    "dq_suite": None,
}


def _checks(kind: str | None) -> Callable[[Layers], DataFrame]:
    return lambda p: check_report(p, kind)


EXTENSIONS: dict[str, Callable[[Layers], DataFrame]] = {
    "ext_seasonality_annualised": lambda p: X.ext_seasonality_annualised(
        p.mart_category_performance, years=SEASON_YEARS),
    "ext_cohort_fixed_window": lambda p: X.ext_cohort_fixed_window(p.fct_orders),
    "ext_seller_sla": lambda p: X.ext_seller_sla(p.int_order_items_enriched, p.fct_orders),
    "ext_order_payments": lambda p: X.ext_order_payments(p.stg_order_payments, p.fct_orders),
    "ext_route_distance": lambda p: X.ext_route_distance(p.int_order_items_enriched, p.fct_orders,
                                                         p.stg_geolocation),
    "ext_lorenz_gini": lambda p: X.ext_lorenz_gini(p.mart_seller_performance),
}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {k: _layer(k) for k in LAYER_KEYS}
    out.update({k: _on(fn, k) for k, fn in ANALYSES.items()})
    out.update({k: _on(_checks(kind), k) for k, kind in CHECK_KEYS.items()})
    out["dq_damaged"] = _on(damaged_report, "dq_damaged")
    out.update({k: _on(fn, k) for k, fn in GENERIC.items()})
    out.update({k: _on(fn, k) for k, fn in EXTENSIONS.items()})
    out.update(IO_KEYS)
    return out
