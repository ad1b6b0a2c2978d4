"""Extensions: analyses the reference describes in prose but does not code.

Each is a plain composition of DataFrame operations over the same layers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import exact_avg, exact_sum, money_sum, rate_pct, round_half_up
from mercato.operators import bucketize
from mercato.operators.nearest import nearest_key
from mercato.plans import analyses as A

EARTH_RADIUS_KM = 6371.0
DISTANCE_EDGES_KM = (25, 50, 100, 250, 500, 1000)


def ext_seasonality_annualised(mart_category: DataFrame, years: Sequence[int] = (2017, 2018),
                               top: int = 15) -> DataFrame:
    """Monthly revenue divided by the number of years that have data for that month."""
    return A.seasonality_by_category(mart_category, years=years, top=top, annualised=True)


def ext_cohort_fixed_window(fct: DataFrame, window_days: int = 90, min_repeat: int = 2) -> DataFrame:
    """Cohort repurchase counting only orders within ``window_days`` of the first order."""
    delivered = fct.where(F.col("order_status") == "delivered").select(
        "customer_unique_id", "order_id", "purchased_at", "purchase_month")
    first = delivered.groupBy("customer_unique_id").agg(
        F.min("purchased_at").alias("first_at"), F.min("purchase_month").alias("cohort_month"))
    within = (delivered.join(first, "customer_unique_id")
              .where(F.col("purchased_at") <= F.expr(f"timestampadd(DAY, {int(window_days)}, first_at)"))
              .groupBy("customer_unique_id", "cohort_month")
              .agg(F.countDistinct("order_id").alias("orders_in_window")))
    repeat = F.col("orders_in_window") >= min_repeat
    return (within.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count_if(repeat).alias("recompradores_janela"),
        rate_pct(repeat).alias("pct_recompra_janela"),
    ).orderBy("cohort_month"))


def ext_seller_sla(items_enriched: DataFrame, orders: DataFrame) -> DataFrame:
    """Per seller: share of shipped items handed to the carrier by the shipping limit."""
    shipped = orders.where(F.col("delivered_to_carrier_at").isNotNull()) \
        .select("order_id", "delivered_to_carrier_at")
    j = items_enriched.select("seller_id", "order_id", "shipping_limit_at").join(shipped, "order_id")
    on_time = F.col("delivered_to_carrier_at") <= F.col("shipping_limit_at")
    return j.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("shipped_items"),
        F.count_if(on_time).alias("on_time_items"),
        rate_pct(on_time).alias("pct_on_time"))


def ext_order_payments(payments: DataFrame, fct: DataFrame) -> DataFrame:
    """Payments aggregated per order first, then joined to the order fact (no fan-out)."""
    per_order = payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_total"),
        F.count(F.lit(1)).alias("payment_count"),
        F.countDistinct("payment_type").alias("payment_types"),
        F.max("payment_installments").alias("max_installments"),
        money_sum(F.when(F.col("payment_type") == "voucher", F.col("payment_value"))).alias("voucher_value"))
    return (fct.select("order_id", "order_gross_value").join(per_order, "order_id", "left")
            .withColumn("payment_gap", (F.col("payment_total") - F.col("order_gross_value"))
                        .cast("decimal(38,2)")))


def haversine_km(lat1, lng1, lat2, lng2):
    rad = math.pi / 180.0
    dlat = (lat2 - lat1) * rad / 2
    dlng = (lng2 - lng1) * rad / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(F.sin(dlng), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(h))


def zip_number(zip_code) -> Column:
    """The number of an all-digit zip prefix, null for others."""
    return F.when(zip_code.rlike("^[0-9]{1,9}$"), zip_code.cast("long"))


def centroids_for(zips: DataFrame, geolocation: DataFrame) -> DataFrame:
    """zip_code_prefix, lat and lng of ``zips`` (zip_code_prefix): the own centroid, else that of the nearest prefix in number."""
    geo = geolocation.select("zip_code_prefix", "lat", "lng")
    own = geo.join(zips, "zip_code_prefix", "left_semi")
    numbered = geo.withColumn("number", zip_number(F.col("zip_code_prefix")))
    # "01001" and "1001" are one number: one of them stands for it
    known = numbered.groupBy("number").agg(F.min_by(F.struct("lat", "lng"), "zip_code_prefix").alias("at"))
    missing = zips.join(geo, "zip_code_prefix", "left_anti")
    near = nearest_key(missing, known, zip_number(F.col("zip_code_prefix")), F.col("number"))
    return own.unionByName(near.select("zip_code_prefix", "found.at.lat", "found.at.lng"))


def ext_route_distance(items_enriched: DataFrame, fct: DataFrame, geolocation: DataFrame,
                       edges_km: Sequence[float] = DISTANCE_EDGES_KM) -> DataFrame:
    """Late rate by seller-to-customer distance band (zip centroid to zip centroid).

    A zip without a centroid takes that of the nearest known prefix; routes with an end that has none near
    are counted in the band ``unknown``.
    """
    ends = items_enriched.select(F.col("seller_zip_code_prefix").alias("zip_code_prefix")).union(fct.select("customer_zip_code_prefix"))
    geo = centroids_for(ends.filter("zip_code_prefix IS NOT NULL").distinct(), geolocation)
    s = geo.select(F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
                   F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng"))
    c = geo.select(F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
                   F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng"))
    pairs = items_enriched.select("order_id", "seller_zip_code_prefix").distinct()
    orders = fct.where(F.col("order_status") == "delivered").select(
        "order_id", "customer_zip_code_prefix", "is_late", "days_to_deliver")
    routes = (pairs.join(orders, "order_id").join(s, "seller_zip_code_prefix", "left")
              .join(c, "customer_zip_code_prefix", "left")
              .withColumn("distance_km", haversine_km(F.col("s_lat"), F.col("s_lng"),
                                                      F.col("c_lat"), F.col("c_lng"))))
    labels = [f"{a}-{b}km" for a, b in zip((0,) + tuple(edges_km), edges_km)] + [f"{edges_km[-1]}km+"]
    band, rank, _ = bucketize("distance_km", edges_km, labels, null_label="unknown")
    return (routes.groupBy(band.alias("distance_band"), rank.alias("band_rank")).agg(
        F.count(F.lit(1)).alias("routes"),
        F.count_if("is_late").alias("late_routes"),
        rate_pct("is_late").alias("pct_late"),
        round_half_up(exact_avg("distance_km"), 1).alias("avg_distance_km"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_to_deliver"),
    ).orderBy("band_rank").drop("band_rank"))


def ext_lorenz_gini(mart_seller: DataFrame) -> DataFrame:
    """Gini coefficient of seller revenue from the ranked Pareto curve (one row)."""
    curve = A.pareto_curve(mart_seller)
    asc_rank = (F.col("total_sellers") + 1 - F.col("rank_revenue")).cast("double")
    x = F.col("seller_revenue").cast("double")
    agg = curve.agg(F.count(F.lit(1)).alias("sellers"),
                    money_sum("seller_revenue").alias("total_revenue"),
                    exact_sum(asc_rank * x).alias("_weighted"),
                    exact_sum(x).alias("_sum"))
    n = F.col("sellers").cast("double")
    gini = F.lit(2.0) * F.col("_weighted") / (n * F.nullif(F.col("_sum"), F.lit(0.0))) - (n + 1) / n
    return agg.select("sellers", "total_revenue", round_half_up(gini, 4).alias("gini"))
