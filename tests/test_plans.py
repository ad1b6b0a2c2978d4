"""Physical-plan properties the design relies on."""

import pytest
from pyspark.sql import functions as F

from mercato.operators import global_rank
from mercato.plans import marts as M
from mercato.plans.build import build_marts
from mercato.plans.generic import win_latest
from mercato.plans.layers import Layers

SF = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    layers = Layers.from_testdata(spark, SF)
    return layers, build_marts(spark, layers, str(tmp_path_factory.mktemp("marts")), gate=False)


def test_delivered_filter_and_columns_reach_the_scan(spark, stored):
    _, marts = stored
    plan = marts.fct_orders.where(F.col("order_status") == "delivered") \
        .select("order_id", "is_late")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "ReadSchema: struct<order_id:bigint,order_status:string,is_late:boolean>" in plan


def test_marts_use_hash_aggregation_only(spark, stored):
    _, marts = stored
    for build in (M.mart_category_performance, M.mart_seller_performance):
        plan = executed(build(marts.items_enriched, marts.fct_orders))
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan


def test_small_dimensions_are_broadcast(spark, stored):
    layers, _ = stored
    plan = layers.int_order_items_enriched._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_rank_joins_offsets_by_hash(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("k"))
    plan = executed(global_rank(df, ["k", "id"], rank_col="r", total_count_col="n", partitions=5))
    assert "BroadcastHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_window_form_of_latest_review_limits_before_shuffle(spark):
    plan = executed(win_latest(Layers.from_testdata(spark, SF)))
    assert "WindowGroupLimit" in plan


def test_hot_order_key_is_split_across_tasks(spark):
    """One order holding a third of all items: AQE splits its join partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 600_000
        items = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 40_000).alias("order_id"),
            F.col("id").alias("order_item_id"), (F.col("id") % 97).alias("product_id"),
            (F.col("id") % 13).alias("seller_id"), F.lit("SP").alias("seller_state"),
            F.lit("X").alias("seller_city"),
            F.concat(F.lit("cat_"), (F.col("id") % 5).cast("string")).alias("product_category_name_en"),
            F.lit(10).cast("decimal(18,2)").alias("item_price"),
            F.lit(11).cast("decimal(18,2)").alias("item_gross_value"),
            F.lit(10.0).alias("item_freight_ratio_pct"), F.lit(100.0).alias("product_weight_g"))
        orders = spark.range(40_000).select(
            F.col("id").alias("order_id"), F.lit("delivered").alias("order_status"),
            F.lit(5).cast("bigint").alias("review_score"), F.lit(False).alias("is_late"),
            F.lit(3).cast("bigint").alias("days_to_deliver"),
            F.lit(0).cast("bigint").alias("delivery_delay_days"),
            F.expr("timestamp_ntz'2018-01-01 00:00:00'").alias("purchased_at"),
            F.expr("date'2018-01-01'").alias("purchase_month"),
            F.lit(2018).cast("bigint").alias("purchase_year"))
        df = M.mart_category_performance(items, orders)
        plan = executed(df)
        assert "SortMergeJoin(skew=true)" in plan
        assert sum(r.total_orders for r in df.collect()) == \
            items.select("order_id", "product_category_name_en").distinct().count()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _jobs_started(spark, build) -> int:
    tracker = spark.sparkContext.statusTracker()
    group = f"built-{id(build)}"
    spark.sparkContext.setJobGroup(group, "construction")
    build()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


@pytest.mark.parametrize("name", ["stg_products", "int_order_items_enriched", "mart_seller_performance"])
def test_construction_runs_footers_only(spark, name):
    """Opening a Parquet source may read its footers (one job each); nothing else runs before an action."""
    layers = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    assert _jobs_started(spark, lambda: getattr(layers, name)) <= 6
    again = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    if name == "stg_products":
        assert _jobs_started(spark, lambda: again.stg_products) <= 1
