"""Source and sink keys: CSV round trip, ingest, profile, SQL over views, mart write/read.

The raw tables are derived from the test tables by Spark, written where the
cluster keeps shared scratch data (under ``spark.checkpoint.dir``) and read back
through the same readers a production ingest uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import staging
from mercato.plans.layers import Layers
from mercato.schemas import RAW_TABLE_NAMES
from mercato.session import scratch_path
from mercato.sources.raw import RAW_SOURCES, ingest_all, profile, read_raw_csv, validated
from mercato.sources.sinks import register_views, run_sql, write_table
from mercato.sources.store import TableStore


def _write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", encoding) \
        .option("quote", '"').option("escape", '"').csv(path)


def src_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, read back with the explicit schema, then staged."""
    layers = Layers.from_testdata(spark, sf_dir)
    path = scratch_path(spark, "csv_orders")
    _write_csv(layers.raw.orders, path)
    return staging.stg_orders(read_raw_csv(spark, path, "orders", id_type="bigint"))


def src_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(Layers.from_testdata(spark, sf_dir).raw.as_dict())


def src_ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine raw tables as CSV (own encodings) -> validate -> parquet -> profile."""
    raw = Layers.from_testdata(spark, sf_dir).raw.as_dict()
    csv_dir, out_dir = scratch_path(spark, "csv_all"), scratch_path(spark, "raw_parquet")
    for name in RAW_TABLE_NAMES:
        _write_csv(raw[name], f"{csv_dir}/{name}.csv", RAW_SOURCES[name].encoding)
    return ingest_all(spark, csv_dir, out_dir, id_type="bigint")


#: Share of late orders and mean delay by state and weekday, with a window over the states' totals.
STATE_WEEKDAY_SQL = """
WITH daily AS (
  SELECT customer_state, purchase_day_of_week, count(*) AS orders, count_if(is_late) AS late,
    sum(delivery_delay_days) AS delay_days
  FROM fct_orders WHERE is_delivered GROUP BY ALL
)
SELECT customer_state, purchase_day_of_week, orders, late, delay_days,
  sum(orders) OVER (PARTITION BY customer_state) AS state_orders
FROM daily
"""


def src_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL text run over the registered order fact view."""
    register_views({"fct_orders": Layers.from_testdata(spark, sf_dir).fct_orders})
    return run_sql(spark, STATE_WEEKDAY_SQL)


def _through_catalog(spark: SparkSession, df: DataFrame, namespace: str, name: str, **how) -> DataFrame:
    """``df`` written as a catalog table of its layer's namespace and read back by name.

    The files lie in a fresh scratch folder and the name is the call's own, so an earlier result that has
    not been read yet keeps its rows.
    """
    path = scratch_path(spark, name)
    table = f"{namespace}.{path.rpartition('/')[2].replace('-', '_')}"
    write_table(df, table, path=path, as_catalog_table=True, **how)
    return spark.table(table).select(*df.columns)


def sink_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category mart, partitioned by year, loaded into a store of versioned tables and read as published."""
    mart = Layers.from_testdata(spark, sf_dir).mart_category_performance
    base = scratch_path(spark, "marts")
    load = TableStore(spark, base).load()
    load.write("mart_category_performance", mart, mode="WRITE_TRUNCATE", partition_by=["purchase_year"])
    load.publish()
    return TableStore(spark, base).read("mart_category_performance")


def src_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate every raw table (raises when empty or with duplicate columns); one row each."""
    raw = Layers.from_testdata(spark, sf_dir).raw.as_dict()
    return validated(raw).select("table_name", "row_count", "column_count", "validation")


def sink_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact loaded into an empty catalog table, partitioned by purchase month."""
    fct = Layers.from_testdata(spark, sf_dir).fct_orders
    return _through_catalog(spark, fct, "mercato_marts", "fct_orders", mode="WRITE_EMPTY", partition_by=["purchase_month"])


def sink_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table as a view, read back by name."""
    register_views({"stg_customers": Layers.from_testdata(spark, sf_dir).stg_customers})
    return spark.table("stg_customers")


IO_KEYS = {"src_raw_csv": src_raw_csv, "src_profile": src_profile, "src_ingest_all": src_ingest_all,
           "src_sql_query": src_sql_query, "sink_mart": sink_mart, "src_validate": src_validate,
           "sink_table": sink_table, "sink_view": sink_view}
