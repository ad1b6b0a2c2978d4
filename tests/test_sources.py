"""CSV ingest (encodings, BOM, quoted newlines), validation, sinks."""

import os

import pytest
from pyspark.sql import functions as F

from mercato.schemas import raw_schema
from mercato.sources.raw import profile, read_raw_csv, validate_frame
from mercato.sources.sinks import WRITE_MODES, read_table, run_sql, register_views, write_table


def _write(path, text, encoding):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_quoted_newline_and_doubled_quotes_are_one_record(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.csv")
    _write(path, "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                 "review_creation_date,review_answer_timestamp\n"
                 'r1,o1,5,,"linha um\nlinha ""dois""",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
                 "r2,o2,4,,,2018-01-01 00:00:00,2018-01-02 11:00:00\n", "utf-8")
    rows = read_raw_csv(spark, path, "order_reviews").orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0].review_comment_message == 'linha um\nlinha "dois"'
    assert rows[1].review_comment_message is None


def test_bom_and_latin1(spark, tmp_dir):
    t = os.path.join(tmp_dir, "translation.csv")
    _write(t, "﻿product_category_name,product_category_name_english\nmoveis_sala,living_room\n",
           "utf-8")
    row = read_raw_csv(spark, t, "category_name_translation").first()
    assert row.product_category_name == "moveis_sala"
    p = os.path.join(tmp_dir, "products.csv")
    _write(p, "product_id,product_category_name,product_name_lenght,product_description_lenght,"
              "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
              "p1,móveis,10,20,1,500,10,10,10\n", "latin-1")
    assert read_raw_csv(spark, p, "products").first().product_category_name == "móveis"


def test_header_must_match_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sellers.csv")
    _write(path, "seller_id,zip,seller_city,seller_state\ns1,01001,x,sp\n", "utf-8")
    with pytest.raises(Exception):
        read_raw_csv(spark, path, "sellers").collect()


def test_validation_refuses_empty_and_duplicate_columns(spark):
    empty = spark.createDataFrame([], raw_schema("sellers"))
    with pytest.raises(ValueError, match="empty"):
        validate_frame(empty, "sellers")
    dup = spark.createDataFrame([(1, 2)], "a long, b long").select("a", F.col("b").alias("a"))
    with pytest.raises(ValueError, match="duplicate"):
        validate_frame(dup, "dup")


def test_profile_and_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x", 2017), (2, "y", 2018)], "id long, s string, year long")
    prof = profile({"t": df}).first()
    assert (prof.table_name, prof.row_count, prof.column_count, prof.column_names) == ("t", 2, 3, "id,s,year")
    path = os.path.join(tmp_dir, "t")
    write_table(df, path, mode="WRITE_TRUNCATE", partition_by=["year"])
    back = read_table(spark, path, like=df)
    assert back.schema == df.schema and back.count() == 2
    with pytest.raises(Exception):
        write_table(df, path, mode="WRITE_EMPTY")
    write_table(df, path, mode="WRITE_APPEND", partition_by=["year"])
    assert read_table(spark, path, like=df).count() == 4
    assert set(WRITE_MODES.values()) == {"overwrite", "append", "errorifexists"}


def test_sql_over_registered_views(spark):
    register_views({"tiny": spark.createDataFrame([(1,), (2,)], "x long")})
    assert run_sql(spark, "SELECT sum(x) AS s FROM tiny").first().s == 3


def test_layers_as_sql_views(spark):
    from mercato.plans import analyses as A
    from mercato.plans.layers import Layers

    layers = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    names = layers.register_views(prefix="v_")
    assert "v_fct_orders" in names and len(names) == 15
    sql = spark.sql("""
        SELECT customer_state, count(*) AS total_orders
        FROM v_fct_orders WHERE order_status = 'delivered' AND review_score IS NOT NULL
        GROUP BY customer_state""")
    expected = {r.customer_state: r.total_orders
                for r in A.satisfaction_by_state(layers.fct_orders, min_orders=1).collect()}
    assert {r.customer_state: r.total_orders for r in sql.collect()} == expected


def test_earlier_results_survive_later_calls(spark):
    from mercato.plans.io_keys import IO_KEYS
    for key in ("src_raw_csv", "src_ingest_all", "sink_table", "sink_mart"):
        first = IO_KEYS[key](spark, "/root/testdata/sf0.001")
        IO_KEYS[key](spark, "/root/testdata/sf0.01")
        n = first.count()
        assert n > 0 and n == IO_KEYS[key](spark, "/root/testdata/sf0.001").count()


def test_write_empty_loads_an_empty_table_only(spark, tmp_dir):
    df = spark.range(3)
    write_table(df.limit(0), f"{tmp_dir}/t")
    write_table(df, f"{tmp_dir}/t", mode="WRITE_EMPTY")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 3
    with pytest.raises(ValueError):
        write_table(df, f"{tmp_dir}/t", mode="WRITE_EMPTY")
    write_table(df, f"{tmp_dir}/new", mode="WRITE_EMPTY")
    assert spark.read.parquet(f"{tmp_dir}/new").count() == 3


def test_catalog_table_in_its_namespace(spark, tmp_dir):
    name = f"mercato_staging.t_{abs(hash(tmp_dir))}"
    write_table(spark.range(4), name, mode="WRITE_EMPTY", path=f"{tmp_dir}/cat", as_catalog_table=True)
    assert spark.table(name).count() == 4
    with pytest.raises(ValueError):
        write_table(spark.range(4), name, mode="WRITE_EMPTY", as_catalog_table=True)
    spark.sql(f"DROP TABLE {name}")
