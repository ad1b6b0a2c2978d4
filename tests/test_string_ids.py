"""The chain does not depend on integer ids: text ids (as in the source files) give the same results."""

from pyspark.sql import functions as F

from mercato.plans import analyses as A
from mercato.plans.layers import Layers
from mercato.sources.testdata import RawTables, raw_tables_from_testdata

ID_COLUMNS = {"order_id", "customer_id", "customer_unique_id", "product_id", "seller_id", "review_id"}


def _as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) if c in ID_COLUMNS else F.col(c)
                       for c in df.columns])


def test_text_ids_give_same_marts_and_analyses(spark):
    raw = raw_tables_from_testdata(spark, "/root/testdata/sf0.001")
    numeric = Layers(raw)
    text = Layers(RawTables(**{k: _as_text(v) for k, v in raw.as_dict().items()}))

    def summary(p):
        cat = p.mart_category_performance.agg(F.sum("total_orders"), F.sum("category_revenue"),
                                              F.sum("late_orders")).first()
        sel = p.mart_seller_performance.agg(F.count("*"), F.sum("total_orders"),
                                            F.sum("seller_revenue")).first()
        pareto = sorted(tuple(r) for r in A.revenue_pareto(p.mart_seller_performance).collect())
        repeat = sorted(tuple(r) for r in A.repeat_vs_new(p.fct_orders).collect())
        return tuple(cat), tuple(sel), pareto, repeat

    assert summary(numeric) == summary(text)


def test_csv_ingest_path_gives_same_marts(spark, tmp_dir):
    from mercato.schemas import RAW_TABLE_NAMES
    from mercato.sources.raw import RAW_SOURCES, ingest_all

    raw = raw_tables_from_testdata(spark, "/root/testdata/sf0.001")
    csv_dir, lake = f"{tmp_dir}/csv", f"{tmp_dir}/lake"
    for name in RAW_TABLE_NAMES:
        (raw.as_dict()[name].write.mode("overwrite").option("header", True)
         .option("encoding", RAW_SOURCES[name].encoding)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")     # the source files' format
         .option("quote", '"').option("escape", '"').csv(f"{csv_dir}/{name}.csv"))
    profile = {r.table_name: r.row_count for r in ingest_all(spark, csv_dir, lake).collect()}
    assert profile["orders"] == 1500 and profile["order_items"] == 6000

    direct, ingested = Layers(raw), Layers.from_raw_dir(spark, lake)

    def summary(p):
        return (tuple(p.mart_category_performance.agg(
                    F.sum("total_orders"), F.sum("category_revenue"), F.sum("late_orders"),
                    F.sum("positive_reviews")).first()),
                tuple(p.mart_seller_performance.agg(
                    F.count("*"), F.sum("seller_revenue"), F.sum("late_orders")).first()),
                sorted(tuple(r) for r in A.promised_vs_actual(p.fct_orders).collect()))

    assert summary(direct) == summary(ingested)
