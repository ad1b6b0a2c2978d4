"""Generic operator keys: each relational / window operator at one of its uses.

Every function takes a ``Layers`` and returns the frame the operator produces
at that point of the pipeline, so each operator can be checked on its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions import money_sum, rate_pct, round_half_up
from mercato.operators import (distinct_rollup, distinct_rows, global_rank, latest_per_key,
                               ntile_from_rank, share_of_total, topk, topk_semi_join, using_left)
from mercato.operators.ranking import write_scratch_table
from mercato.plans import analyses as A
from mercato.plans.layers import Layers
from mercato.sources.testdata import SEASON_YEARS



def _delivered(p: Layers) -> DataFrame:
    return p.fct_orders.where(F.col("order_status") == "delivered")


def op_project(p: Layers) -> DataFrame:
    return p.stg_products.select("product_id", "product_category_name_pt", "product_name_length",
                                 "product_volume_cm3")


def op_filter(p: Layers) -> DataFrame:
    return _delivered(p).select("order_id", "customer_unique_id", "purchase_month", "is_late")


def op_filter_in(p: Layers) -> DataFrame:
    return (p.mart_category_performance.where(F.col("purchase_year").isin(*SEASON_YEARS))
            .select("category", "purchase_year", "purchase_month", "category_revenue"))


def op_filter_not_null(p: Layers) -> DataFrame:
    return (_delivered(p).where(F.col("days_to_deliver").isNotNull()
                                & F.col("days_promised").isNotNull())
            .select("order_id", "days_promised", "days_to_deliver"))


def op_filter_range(p: Layers, min_orders: int = 100) -> DataFrame:
    by_category = p.mart_category_performance.groupBy("category").agg(
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        money_sum("category_revenue").alias("total_revenue"))
    return by_category.where(F.col("total_orders") >= min_orders)


def op_having(p: Layers, min_orders: int = 100) -> DataFrame:
    routes = (distinct_rows(p.int_order_items_enriched, ["order_id", "seller_state"])
              .join(_delivered(p).select("order_id", "customer_state", "is_late"), "order_id"))
    agg = routes.groupBy("seller_state", "customer_state").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.count_if("is_late").alias("late_orders"))
    return agg.where(F.col("total_orders") >= min_orders)


def op_left_join(p: Layers) -> DataFrame:
    """Orders with what is known of their customer and review; every order stays."""
    return (p.stg_orders.select("order_id", "customer_id")
            .join(p.stg_customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
            .join(p.stg_order_reviews.select("order_id", "review_score"), "order_id", "left")
            .select("order_id", "customer_unique_id", "review_score"))


def op_inner_join(p: Layers) -> DataFrame:
    return (p.int_order_items_enriched.select("order_id", "order_item_id", "seller_id")
            .join(_delivered(p).select("order_id", "is_late"), "order_id"))


def op_using_multi(p: Layers) -> DataFrame:
    """Order and seller counts by category and month; every month with orders stays, by the three shared keys."""
    keys = ["category", "purchase_year", "purchase_month"]
    lines = (p.int_order_items_enriched.select(F.col("product_category_name_en").alias("category"), "order_id", "seller_id")
             .join(_delivered(p).select("order_id", "purchase_year", "purchase_month"), "order_id"))
    orders = lines.select(*keys, "order_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("total_orders"))
    sellers = lines.select(*keys, "seller_id").distinct().groupBy(*keys).agg(F.count("seller_id").alias("active_sellers"))
    return using_left(orders, sellers, keys)


def _monthly(p: Layers) -> DataFrame:
    return (p.mart_category_performance.where(F.col("purchase_year").isin(*SEASON_YEARS))
            .groupBy("category", F.month("purchase_month").cast("bigint").alias("mes"))
            .agg(F.sum("category_revenue").alias("revenue_mes")))


def op_topk_semi_join(p: Layers, k: int = 15) -> DataFrame:
    monthly = _monthly(p)
    totals = monthly.groupBy("category").agg(F.sum("revenue_mes").alias("total"))
    kept = topk_semi_join(monthly, totals, "category",
                          [F.col("total").desc(), F.col("category").asc()], k)
    return kept.select("category", "mes", F.col("revenue_mes").cast("decimal(38,2)").alias("revenue_mes"))


def op_self_join_agg(p: Layers) -> DataFrame:
    delivered = _delivered(p)
    summary = delivered.groupBy("customer_unique_id").agg(
        F.countDistinct("order_id").alias("qtd_pedidos"))
    return (delivered.select("order_id", "customer_unique_id").join(summary, "customer_unique_id")
            .withColumn("segmento", F.when(F.col("qtd_pedidos") >= 2, A.REPEAT_LABEL)
                        .otherwise(A.NEW_LABEL)))


def op_group_agg(p: Layers) -> DataFrame:
    return (_delivered(p).where(F.col("review_score").isNotNull()).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        rate_pct("is_late").alias("pct_late")))


def op_global_agg(p: Layers, cut: float = 1.0) -> DataFrame:
    curve = A.pareto_curve(p.mart_seller_performance)
    inside = F.col("seller_pct") <= F.lit(float(cut))
    return curve.agg(F.max(F.when(inside, F.col("revenue_pct_cumulative"))).alias("receita_acumulada_pct"),
                     F.count_if(inside).alias("qtd_sellers"))


def op_distinct(p: Layers) -> DataFrame:
    return distinct_rows(p.int_order_items_enriched, ["order_id", "seller_state"])


def op_count_distinct(p: Layers) -> DataFrame:
    j = (p.int_order_items_enriched.select(F.col("product_category_name_en").alias("category"),
                                           "order_id", "seller_id")
         .join(_delivered(p).select("order_id", "purchase_year", "purchase_month"), "order_id"))
    return j.groupBy("category", "purchase_year", "purchase_month").agg(
        F.countDistinct("seller_id").alias("active_sellers"))


def op_distinct_rollup(p: Layers) -> DataFrame:
    """Active sellers of a category by month, by year and over all time, from one state a seller."""
    j = (p.int_order_items_enriched.select(F.col("product_category_name_en").alias("category"),
                                           "order_id", "seller_id")
         .join(_delivered(p).select("order_id", "purchase_month"), "order_id"))
    return distinct_rollup(j, ["category"], "seller_id", "purchase_month", "active_sellers")


def op_two_level_agg(p: Layers) -> DataFrame:
    first = _delivered(p).groupBy("customer_unique_id").agg(
        F.min("purchase_month").alias("cohort_month"),
        F.countDistinct("order_id").alias("total_orders"))
    return first.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count_if(F.col("total_orders") >= 2).alias("recompradores"))


def op_latest_per_key(p: Layers) -> DataFrame:
    latest = latest_per_key(p.raw.order_reviews, ["order_id"], ["review_answer_timestamp", "review_id"])
    return latest.select("order_id", "review_id", "review_score")


def op_sort(p: Layers) -> DataFrame:
    return (_delivered(p).select("order_id", "purchased_at")
            .orderBy(F.col("purchased_at").desc(), F.col("order_id").asc()))


def op_topk(p: Layers, k: int = 10) -> DataFrame:
    return topk(p.mart_seller_performance.select("seller_id", "seller_revenue"),
                [F.col("seller_revenue").desc(), F.col("seller_id").desc()], k)


def op_union_all(p: Layers, cuts=A.PARETO_CUTS) -> DataFrame:
    """The Pareto cut-offs written literally: one filtered aggregate per cut over the stored curve, unioned."""
    curve = write_scratch_table(A.pareto_curve(p.mart_seller_performance), "curve")
    parts = [curve.where(F.col("seller_pct") <= F.lit(float(c))).agg(
                F.lit(f"top {A.pct_label(c)}%").alias("faixa"),
                F.max("revenue_pct_cumulative").alias("receita_acumulada_pct"),
                F.count(F.lit(1)).alias("qtd_sellers"))
             for c in cuts]
    return reduce(lambda a, b: a.unionByName(b), parts)


def win_latest(p: Layers) -> DataFrame:
    """Latest review per order written as the window form (row_number = 1)."""
    w = Window.partitionBy("order_id").orderBy(F.col("review_answer_timestamp").desc(),
                                               F.col("review_id").desc())
    return (p.raw.order_reviews.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
            .select("order_id", "review_id", "review_score"))


def _curve(p: Layers) -> DataFrame:
    return A.pareto_curve(p.mart_seller_performance)


def win_global_rank(p: Layers) -> DataFrame:
    return _curve(p).select("seller_id", "rank_revenue")


def win_grand_total(p: Layers) -> DataFrame:
    ranked = global_rank(p.mart_seller_performance.select("seller_id", "seller_revenue"),
                         ["seller_revenue", "seller_id"], descending=True, rank_col="rank_revenue",
                         running_sum="seller_revenue", total_count_col="total_sellers",
                         total_sum_col="total_revenue")
    return ranked.select("seller_id", "total_sellers", "total_revenue")


def win_running_share(p: Layers) -> DataFrame:
    return _curve(p).select("seller_id", "rank_revenue", "revenue_pct_cumulative")


def win_partition_share(p: Layers) -> DataFrame:
    return share_of_total(_monthly(p), ["category"], "revenue_mes", "revenue_categoria_total")


def win_ntile(p: Layers, n: int = 5) -> DataFrame:
    ranked = global_rank(p.mart_seller_performance.select("seller_id", "total_orders"),
                         ["total_orders", "seller_id"], rank_col="r", total_count_col="n")
    return ranked.select("seller_id", "total_orders", ntile_from_rank("r", "n", n).alias("volume_bucket"))


GENERIC = {name: fn for name, fn in dict(globals()).items()
           if (name.startswith("op_") or name.startswith("win_")) and callable(fn)}
