"""The twelve business analyses (plus the Pareto curve itself).

Thresholds are parameters; defaults are the reference's. Where the reference
orders or limits on values that can tie, a deterministic tie-breaker is added
(category / state / seller id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import avg_money, exact_avg, rate_pct, round_half_up, weighted_mean
from mercato.operators import (bucketize, global_rank, global_ranks, ntile_from_rank, share_of_total,
                               topk, topk_semi_join)

FREIGHT_EDGES = (5, 10, 15, 20, 30, 50)
PARETO_CUTS = (1, 5, 10, 20, 50, 100)

# Output labels of the analyses.
# Category quadrants: high revenue + high review, high revenue + low review,
# low revenue + high review, low revenue + low review, anything else.
QUADRANT_LABELS = ("vaca_leiteira", "risco_reputacional", "potencial", "candidata_descontinuar",
                   "intermediaria")
OTHER_REGION_LABEL = "Outros"
REPEAT_LABEL, NEW_LABEL = "recorrente", "novo"


def _delivered(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_status") == "delivered")


def late_rate_by_category(items_enriched: DataFrame, orders_enriched: DataFrame,
                          min_orders: int = 100, limit: int = 20) -> DataFrame:
    """Late-delivery rate per category (one row per category, order, is_late, weight)."""
    orders = _delivered(orders_enriched).select("order_id", "is_late")
    co = (items_enriched.select(F.col("product_category_name_en").alias("category"),
                                "order_id", "product_weight_g")
          .join(orders, "order_id")
          .select("category", "order_id", "is_late", "product_weight_g")
          .distinct())
    agg = co.groupBy("category").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.count_if("is_late").alias("late_orders"),
        rate_pct("is_late", F.countDistinct("order_id")).alias("pct_late"),
        round_half_up(exact_avg("product_weight_g"), 0).alias("avg_weight_g"),
    )
    return topk(agg.where(F.col("total_orders") >= min_orders),
                [F.col("pct_late").desc(), F.col("category").asc()], limit)


def promised_vs_actual(fct: DataFrame) -> DataFrame:
    """Promised against actual delivery days per purchase year and month."""
    base = _delivered(fct).where(F.col("days_to_deliver").isNotNull()
                                 & F.col("days_promised").isNotNull())
    return (base.groupBy("purchase_year", "purchase_month_num").agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_half_up(F.avg("days_promised"), 1).alias("avg_days_promised"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_actual"),
        round_half_up(F.avg(F.col("days_promised") - F.col("days_to_deliver")), 1).alias("buffer_days"),
        F.count_if("is_late").alias("late_orders"),
        rate_pct("is_late").alias("pct_late"),
    ).orderBy("purchase_year", "purchase_month_num"))


def late_by_route(items_enriched: DataFrame, fct: DataFrame, min_orders: int = 100,
                  limit: int = 30) -> DataFrame:
    """Late rate per (seller state, customer state) route."""
    seller_per_order = items_enriched.select("order_id", "seller_state").distinct()
    orders = _delivered(fct).select("order_id", "customer_state", "is_late", "days_to_deliver")
    routes = seller_per_order.join(orders, "order_id").withColumn(
        "intrastate",
        F.when(F.col("seller_state") == F.col("customer_state"), 1).otherwise(0).cast("bigint"))
    agg = routes.groupBy("seller_state", "customer_state", "intrastate").agg(
        F.count(F.lit(1)).alias("total_orders"),  # rows are distinct per (order, seller state)
        F.count_if("is_late").alias("late_orders"),
        rate_pct("is_late").alias("pct_late"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_to_deliver"),
    )
    return topk(agg.where(F.col("total_orders") >= min_orders),
                [F.col("pct_late").desc(), F.col("seller_state").asc(),
                 F.col("customer_state").asc()], limit)


def category_quadrants(mart_category: DataFrame, min_orders: int = 100, n: int = 4) -> DataFrame:
    """Revenue quartile x review quartile classification of categories."""
    by_category = mart_category.groupBy("category").agg(
        F.sum("category_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.sum("total_orders").cast("bigint").alias("total_orders"),
        round_half_up(F.sum("category_revenue").cast("double")
                      / F.nullif(F.sum("total_orders"), F.lit(0)), 2).alias("avg_ticket"),
        weighted_mean("avg_review_score", "total_orders", 2, guard_zero=True)
        .alias("weighted_review_score"),
        round_half_up(F.sum("late_orders") * F.lit(100.0)
                      / F.nullif(F.sum("total_orders"), F.lit(0)), 2).alias("pct_late"),
    ).where(F.col("total_orders") >= min_orders)
    orders = {"__rr": (["total_revenue", "category"], False), "__vr": (["weighted_review_score", "category"], False)}
    ranked = global_ranks(by_category, orders, ["category"], total_count_col="__n")
    ranked = ranked.withColumns({"revenue_quartile": ntile_from_rank("__rr", "__n", n),
                                 "review_quartile": ntile_from_rank("__vr", "__n", n)})
    rq, vq = F.col("revenue_quartile"), F.col("review_quartile")
    top_top, top_low, low_top, low_low, other = QUADRANT_LABELS
    label = (F.when((rq == n) & (vq == n), top_top)
             .when((rq == n) & (vq == 1), top_low)
             .when((rq == 1) & (vq == n), low_top)
             .when((rq == 1) & (vq == 1), low_low)
             .otherwise(other))
    return ranked.select("category", "total_orders", "total_revenue", "avg_ticket",
                         "weighted_review_score", "pct_late", "revenue_quartile",
                         "review_quartile", label.alias("classificacao")) \
        .orderBy(F.col("total_revenue").desc(), F.col("category").asc())


def freight_bucket_satisfaction(fct: DataFrame, edges: Sequence[float] = FREIGHT_EDGES) -> DataFrame:
    """Review score by bucket of the order's freight-to-price ratio."""
    label, rank, _ = bucketize("order_freight_ratio_pct", edges)
    base = (_delivered(fct).where(F.col("review_score").isNotNull()
                                  & F.col("order_freight_ratio_pct").isNotNull())
            .select(label.alias("freight_ratio_bucket"), rank.alias("__rank"), "review_score"))
    neg, pos = F.col("review_score") <= 2, F.col("review_score") >= 4
    return (base.groupBy("freight_ratio_bucket", "__rank").agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        F.count_if(neg).alias("negative_reviews"),
        rate_pct(neg).alias("pct_negative"),
        F.count_if(pos).alias("positive_reviews"),
        rate_pct(pos).alias("pct_positive"),
    ).orderBy("__rank").drop("__rank"))


def seasonality_by_category(mart_category: DataFrame, years: Sequence[int] = (2017, 2018),
                            top: int = 15, annualised: bool = False) -> DataFrame:
    """Share of each month in a category's revenue, for the top categories by revenue."""
    base = mart_category.where(F.col("purchase_year").isin(*years))
    mes = F.month("purchase_month").cast("bigint").alias("mes")
    if annualised:
        # revenue per year that has data for the month (removes the overlap bias)
        monthly = base.groupBy("category", mes).agg(
            (F.sum("category_revenue").cast("double") / F.countDistinct("purchase_year"))
            .alias("revenue_mes"))
    else:
        monthly = base.groupBy("category", mes).agg(F.sum("category_revenue").alias("revenue_mes"))
    with_total = share_of_total(monthly, ["category"], "revenue_mes", "__total")
    totals = monthly.groupBy("category").agg(F.sum("revenue_mes").alias("__total"))
    kept = topk_semi_join(with_total, totals, "category",
                          [F.col("__total").desc(), F.col("category").asc()], top)
    rev = (round_half_up("revenue_mes", 2) if annualised
           else F.col("revenue_mes").cast("decimal(38,2)"))
    share = round_half_up(F.col("revenue_mes").cast("double") * F.lit(100.0)
                          / F.nullif(F.col("__total"), F.lit(0)).cast("double"), 2)
    return kept.select("category", "mes", rev.alias("revenue_mes"), share.alias("share_pct")) \
        .orderBy("category", "mes")


def region_comparison(mart_seller: DataFrame, focus: str = "SP", min_orders: int = 10) -> DataFrame:
    """Sellers of one state against all others (volume-weighted quality)."""
    classified = mart_seller.where(F.col("total_orders") >= min_orders).withColumn(
        "regiao", F.when(F.col("seller_state") == focus, F.lit(focus)).otherwise(F.lit(OTHER_REGION_LABEL)))
    return classified.groupBy("regiao").agg(
        F.count(F.lit(1)).alias("qtd_sellers"),
        F.sum("total_orders").cast("bigint").alias("total_pedidos"),
        weighted_mean("avg_review_score", "total_orders", 2).alias("weighted_review_score"),
        weighted_mean("avg_days_to_deliver", "total_orders", 1).alias("weighted_days_to_deliver"),
        weighted_mean("avg_delay_days", "total_orders", 1).alias("weighted_delay_days"),
        weighted_mean("pct_late_orders", "total_orders", 2).alias("weighted_pct_late"),
    ).orderBy("regiao")


def pareto_curve(mart_seller: DataFrame) -> DataFrame:
    """Sellers ranked by revenue with their cumulative share of revenue."""
    ranked = global_rank(
        mart_seller.select("seller_id", "seller_state", "seller_revenue", "total_orders"),
        ["seller_revenue", "seller_id"], descending=True, rank_col="rank_revenue",
        running_sum="seller_revenue", running_col="__cum", total_count_col="total_sellers",
        total_sum_col="__total")
    return ranked.select(
        "seller_id", "seller_state", "seller_revenue", "total_orders", "rank_revenue",
        "total_sellers",
        round_half_up(F.col("rank_revenue") * F.lit(100.0) / F.col("total_sellers"), 2).alias("seller_pct"),
        round_half_up(F.col("__cum").cast("double") * F.lit(100.0) / F.col("__total").cast("double"), 2)
        .alias("revenue_pct_cumulative"),
    )


def revenue_pareto(mart_seller: DataFrame, cuts: Sequence[float] = PARETO_CUTS) -> DataFrame:
    """Cumulative revenue share and seller count at each top-x% cut, in one pass.

    A single global aggregate with one conditional max/count per cut (partial
    aggregation, no union of repeated scans); an empty cut yields (null, 0).
    """
    curve = pareto_curve(mart_seller)
    inside = [F.col("seller_pct") <= F.lit(float(c)) for c in cuts]
    aggs = []
    for i, cond in enumerate(inside):
        aggs += [F.max(F.when(cond, F.col("revenue_pct_cumulative"))).alias(f"m{i}"),
                 F.count_if(cond).alias(f"c{i}")]
    wide = curve.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f"top {pct_label(c)}%").alias("faixa"),
                              F.col(f"m{i}").alias("receita_acumulada_pct"),
                              F.col(f"c{i}").alias("qtd_sellers"))
                     for i, c in enumerate(cuts)])
    return wide.select(F.inline(rows)).orderBy("qtd_sellers", "faixa")


def pct_label(c) -> str:
    return str(int(c)) if float(c).is_integer() else str(c)


def volume_quality_quintiles(mart_seller: DataFrame, n: int = 5) -> DataFrame:
    """Sellers in n volume buckets (ntile by total orders) with weighted quality."""
    ranked = global_rank(mart_seller.select("seller_id", "total_orders", "avg_review_score",
                                            "avg_days_to_deliver", "pct_late_orders"),
                         ["total_orders", "seller_id"], rank_col="__r", total_count_col="__n")
    bucketed = ranked.withColumn("volume_bucket", ntile_from_rank("__r", "__n", n))
    return bucketed.groupBy("volume_bucket").agg(
        F.count(F.lit(1)).alias("qtd_sellers"),
        F.min("total_orders").alias("min_orders"),
        F.max("total_orders").alias("max_orders"),
        round_half_up(F.avg("total_orders"), 0).alias("avg_orders"),
        F.sum("total_orders").cast("bigint").alias("total_orders_faixa"),
        weighted_mean("avg_review_score", "total_orders", 2).alias("weighted_review"),
        weighted_mean("avg_days_to_deliver", "total_orders", 1).alias("weighted_days"),
        weighted_mean("pct_late_orders", "total_orders", 2).alias("weighted_pct_late"),
    ).orderBy("volume_bucket")


def _first_purchase(fct: DataFrame) -> DataFrame:
    return _delivered(fct).groupBy("customer_unique_id").agg(
        F.min("purchase_month").alias("cohort_month"),
        F.count("order_id").alias("total_orders"))  # order_id is unique in the fact


def cohort_repurchase(fct: DataFrame, min_repeat: int = 2) -> DataFrame:
    """Repurchase rate of each first-purchase monthly cohort."""
    repeat = F.col("total_orders") >= min_repeat
    return (_first_purchase(fct).groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count_if(repeat).alias("recompradores"),
        rate_pct(repeat).alias("pct_recompra"),
    ).where(F.col("cohort_month").isNotNull()).orderBy("cohort_month"))


def repeat_vs_new(fct: DataFrame, min_repeat: int = 2) -> DataFrame:
    """Orders of repeat buyers against orders of one-time buyers.

    Sums and counts per person, then per segment: the fact is read once and joined with nothing, and a
    person with a huge share of the orders is combined before the shuffle. Orders without a person
    belong to no segment.
    """
    means = {"order_revenue": "avg_ticket", "order_freight_value": "avg_freight", "review_score": "avg_review_score"}
    person = _delivered(fct).where(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.count("order_id").alias("orders"),
        F.count_if("is_late").alias("late"),
        *[F.sum(c).alias(f"{c}_sum") for c in means],
        *[F.count(c).alias(f"{c}_n") for c in means])
    segment = F.when(F.col("orders") >= min_repeat, REPEAT_LABEL).otherwise(NEW_LABEL)
    return person.groupBy(segment.alias("segmento")).agg(
        F.count(F.lit(1)).alias("qtd_clientes"),
        F.sum("orders").alias("qtd_pedidos"),
        *[round_half_up(F.sum(f"{c}_sum").cast("double") / F.nullif(F.sum(f"{c}_n"), F.lit(0)), 2).alias(name)
          for c, name in means.items()],
        round_half_up(F.sum("late") * F.lit(100.0) / F.sum("orders"), 2).alias("pct_late"),
    ).orderBy("segmento")


def satisfaction_by_state(fct: DataFrame, min_orders: int = 100) -> DataFrame:
    """Review profile of delivered, reviewed orders per customer state."""
    base = _delivered(fct).where(F.col("review_score").isNotNull())
    pos, neg = F.col("review_score") >= 4, F.col("review_score") <= 2
    by_state = base.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_half_up(F.avg("review_score"), 2).alias("avg_review_score"),
        rate_pct(pos).alias("pct_positive"),
        rate_pct(neg).alias("pct_negative"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_to_deliver"),
        rate_pct("is_late").alias("pct_late"),
    ).where(F.col("total_orders") >= min_orders)
    return by_state.select(
        "customer_state", "total_orders", "avg_review_score", "pct_positive", "pct_negative",
        (F.col("pct_positive") - F.col("pct_negative")).alias("net_score"),
        "avg_days_to_deliver", "pct_late",
    ).orderBy(F.col("net_score").desc(), F.col("customer_state").asc())
