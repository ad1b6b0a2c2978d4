"""Derive the nine raw marketplace tables from the driver's synthetic tables.

Test support only. The synthetic star schema (orders, lineitem, customer,
part, supplier, nation) has different columns, so each raw table is a Spark
projection of it; the SQL oracle builds the same tables with the same
expressions. Nothing is collected: every table grows with the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Fixed values of the adapter (must equal the oracle's):
PURCHASE = "timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate)"
APPROVED = f"timestampadd(HOUR, cast(o_orderkey % 48 as int), {PURCHASE})"
MONEY_OF = "cast(cast({x} as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(18,2))"
CENTS = MONEY_OF.format(x="cast(round({x} * 100) as bigint)")
UNTRANSLATED_BRANDS = ("Brand#24", "Brand#25")
# Parameters of the analyses on the synthetic tables, whose dates and states differ from the real ones.
SEASON_YEARS = (1997, 1998)
FOCUS_STATE = "NATION_7"


def _score(salt: str) -> str:
    k = f"((o_orderkey * 37 + o_custkey * 11{salt}) % 100)"
    return (f"case when {k} < 58 then 5 when {k} < 77 then 4 when {k} < 85 then 3 "
            f"when {k} < 88 then 2 else 1 end")


def load_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class RawTables:
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    category_name_translation: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def raw_orders(o: DataFrame) -> DataFrame:
    return o.selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as customer_id",
        "case when o_orderstatus in ('F','O') then ' Delivered ' else case o_orderkey % 4 "
        "when 0 then 'CANCELED' when 1 then 'shipped ' when 2 then 'processing' "
        "else 'unavailable' end end as order_status",
        f"{PURCHASE} as order_purchase_timestamp",
        f"case when o_orderstatus = 'P' and o_orderkey % 4 = 0 then null else {APPROVED} end"
        " as order_approved_at",
        "case when o_orderstatus in ('F','O') or o_orderkey % 4 = 1 then "
        f"timestampadd(DAY, cast(1 + o_orderkey % 5 as int), {APPROVED}) end"
        " as order_delivered_carrier_date",
        "case when o_orderstatus in ('F','O') then timestampadd(DAY, "
        f"cast(2 + (o_orderkey * 13 + o_custkey * 5) % 24 as int), {PURCHASE}) end"
        " as order_delivered_customer_date",
        "timestampadd(DAY, cast(14 + (o_orderkey * 7) % 20 as int), o_orderdate)"
        " as order_estimated_delivery_date",
    )


def raw_customers(o: DataFrame, c: DataFrame, n: DataFrame) -> DataFrame:
    return (o.select("o_orderkey", "o_custkey")
            .join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(n.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "o_orderkey as customer_id",
                "case when o_orderkey % 10 < 2 then o_custkey else 10000000 + o_orderkey end"
                " as customer_unique_id",
                "c_custkey % 100 as customer_zip_code_prefix",
                "' ' || lower(n_name) || ' ' as customer_city",
                "' ' || lower(n_name) as customer_state"))


def raw_order_items(li: DataFrame, o: DataFrame) -> DataFrame:
    line_order = Window.partitionBy("l_orderkey").orderBy(
        "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice")
    # small whole numbers travel in place of three doubles, and pack better
    counted = li.selectExpr("*", "cast(round(l_extendedprice * 100) as bigint) as cents",
                            "cast(round((2 * l_discount + 5 * l_tax) * 100) as bigint) as share")
    # dealt by order once: numbering and all later work on orders stay in tasks of the shuffle's size, not the scan's
    return (counted.repartition("l_orderkey")
            .join(o.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("order_item_id", F.row_number().over(line_order).cast("bigint"))
            .selectExpr(
                "l_orderkey as order_id",
                "order_item_id",
                "l_partkey as product_id",
                "l_suppkey as seller_id",
                "timestampadd(DAY, cast(2 + l_orderkey % 4 as int), o_orderdate) as shipping_limit_date",
                MONEY_OF.format(x="cents") + " as price",
                MONEY_OF.format(x="((cents * share) div 100)") + " as freight_value"))


def raw_order_payments(o: DataFrame) -> DataFrame:
    first = o.selectExpr(
        "o_orderkey as order_id",
        "cast(1 as bigint) as payment_sequential",
        "case substr(o_orderpriority, 1, 1) when '1' then ' Credit_Card' when '2' then 'boleto' "
        "when '3' then 'VOUCHER' when '4' then 'debit_card' else 'not_defined' end as payment_type",
        "cast(1 + o_orderkey % 12 as bigint) as payment_installments",
        CENTS.format(x="o_totalprice") + " as payment_value")
    second = o.where("o_orderkey % 20 = 0").selectExpr(
        "o_orderkey as order_id",
        "cast(2 as bigint) as payment_sequential",
        "'voucher' as payment_type",
        "cast(1 as bigint) as payment_installments",
        "cast(10 as decimal(18,2)) as payment_value")
    return first.unionByName(second)


def raw_order_reviews(o: DataFrame) -> DataFrame:
    created = f"timestampadd(DAY, 20, {PURCHASE})"
    first = o.where("o_orderkey % 50 <> 0").selectExpr(
        "o_orderkey * 10 + 1 as review_id",
        "o_orderkey as order_id",
        f"cast({_score('')} as bigint) as review_score",
        "cast(null as string) as review_comment_title",
        "case when o_orderkey % 3 = 0 then 'ok' end as review_comment_message",
        f"{created} as review_creation_date",
        f"timestampadd(DAY, cast(20 + o_orderkey % 3 as int), {PURCHASE}) as review_answer_timestamp")
    second = o.where("o_orderkey % 17 = 0").selectExpr(
        "o_orderkey * 10 + 2 as review_id",
        "o_orderkey as order_id",
        f"cast({_score(' + 29')} as bigint) as review_score",
        "'segunda' as review_comment_title",
        "cast(null as string) as review_comment_message",
        f"{created} as review_creation_date",
        "timestampadd(DAY, cast(20 + o_orderkey % 3 + o_orderkey % 2 as int), "
        f"{PURCHASE}) as review_answer_timestamp")
    return first.unionByName(second)


def raw_products(p: DataFrame) -> DataFrame:
    return p.selectExpr(
        "p_partkey as product_id",
        "case when p_partkey % 97 = 0 then null else p_brand end as product_category_name",
        "cast(length(p_name) as double) as product_name_lenght",
        "cast(p_size * 10 as double) as product_description_lenght",
        "cast(case when p_partkey % 53 = 0 then null else 1 + p_partkey % 6 end as double)"
        " as product_photos_qty",
        "cast(case when p_partkey % 53 = 0 then null else p_size * 100 end as double)"
        " as product_weight_g",
        "cast(p_size as double) as product_length_cm",
        "cast(1 + p_size % 10 as double) as product_height_cm",
        "cast(2 + p_size % 7 as double) as product_width_cm")


def raw_sellers(s: DataFrame, n: DataFrame) -> DataFrame:
    return (s.select("s_suppkey", "s_nationkey")
            .join(n.select("n_nationkey", "n_name"),
                  F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "s_suppkey as seller_id",
                "s_suppkey % 100 as seller_zip_code_prefix",
                "' ' || lower(n_name) || ' ' as seller_city",
                "lower(n_name) || ' ' as seller_state"))


def raw_geolocation(c: DataFrame) -> DataFrame:
    return c.selectExpr(
        "c_custkey % 100 as geolocation_zip_code_prefix",
        "cast(c_custkey % 1000 as double) / 64 - 8 as geolocation_lat",
        "0 - cast(c_custkey % 777 as double) / 32 as geolocation_lng",
        "' City_' || cast(c_custkey % 100 as string) as geolocation_city",
        "'st_' || cast(c_custkey % 100 % 27 as string) as geolocation_state")


def raw_category_translation(p: DataFrame) -> DataFrame:
    return (p.where(~F.col("p_brand").isin(*UNTRANSLATED_BRANDS))
            .selectExpr("p_brand as product_category_name",
                        "'cat_' || substr(p_brand, 7) as product_category_name_english")
            .distinct())


def raw_tables_from_testdata(spark: SparkSession, sf_dir: str) -> DerivedRawTables:
    """All nine raw tables; a table's sources are opened when it is first asked for."""
    return DerivedRawTables(spark, sf_dir)


class DerivedRawTables:
    """The raw tables by name, each derived on first use from the sources it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        source = cache(lambda name: load_source(spark, sf_dir, name))
        self._made: dict[str, DataFrame] = {}
        self._make = {
            "orders": lambda: raw_orders(source("orders")),
            "order_items": lambda: raw_order_items(source("lineitem"), source("orders")),
            "order_payments": lambda: raw_order_payments(source("orders")),
            "order_reviews": lambda: raw_order_reviews(source("orders")),
            "customers": lambda: raw_customers(source("orders"), source("customer"), source("nation")),
            "products": lambda: raw_products(source("part")),
            "sellers": lambda: raw_sellers(source("supplier"), source("nation")),
            "geolocation": lambda: raw_geolocation(source("customer")),
            "category_name_translation": lambda: raw_category_translation(source("part")),
        }

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._make:
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self._make}
