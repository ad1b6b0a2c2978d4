"""Raw CSV ingest: explicit schema per table, per-file encoding, validation, profile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.schemas import RAW_TABLE_NAMES, raw_schema
from mercato.sources.split_csv import read_split_csv
from mercato.sources.store import TableStore, refuse_duplicates


@dataclass(frozen=True)
class RawSource:
    name: str          # logical table name (also the stored table name)
    encoding: str      # charset of the file
    multiline: bool    # free text with quoted newlines


# Encoding per raw file. The product file is Latin-1; the category
# dictionary starts with a UTF-8 byte-order mark, which Spark's reader drops.
RAW_SOURCES: dict[str, RawSource] = {
    "orders": RawSource("orders", "UTF-8", False),
    "order_items": RawSource("order_items", "UTF-8", False),
    "order_payments": RawSource("order_payments", "UTF-8", False),
    "order_reviews": RawSource("order_reviews", "UTF-8", True),
    "customers": RawSource("customers", "UTF-8", False),
    "products": RawSource("products", "ISO-8859-1", False),
    "sellers": RawSource("sellers", "UTF-8", False),
    "geolocation": RawSource("geolocation", "UTF-8", False),
    "category_name_translation": RawSource("category_name_translation", "UTF-8", False),
}


def read_raw_csv(spark: SparkSession, path: str, name: str, *, id_type: str = "string",
                 encoding: str | None = None) -> DataFrame:
    """Read one raw CSV file (or folder of parts) with the table's explicit schema.

    A large file is read by many tasks, also where free text holds line ends (``split_csv``). The
    header must match the schema's column names.
    """
    src = RAW_SOURCES[name]
    if src.multiline:
        return read_split_csv(spark, path, raw_schema(name, id_type), encoding=encoding or src.encoding)
    return (spark.read.schema(raw_schema(name, id_type))
            .option("header", True)
            .option("enforceSchema", False)
            .option("quote", '"').option("escape", '"')
            .option("encoding", encoding or src.encoding)
            .option("mode", "FAILFAST")
            .csv(path))


def validate_frame(df: DataFrame, name: str = "frame") -> DataFrame:
    """Refuse an empty frame or one with duplicate column names (raises ValueError)."""
    refuse_duplicates(df.columns, name)
    if df.isEmpty():
        raise ValueError(f"{name}: empty frame, load refused")
    return df


def profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: row count, column count, column names (one Spark job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                F.lit(",".join(df.columns)).alias("column_names"))
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def validated(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The profile of tables that may be loaded, in one pass; reading it raises where a table is empty."""
    for name, df in frames.items():
        refuse_duplicates(df.columns, name)
    refused = F.raise_error(F.concat("table_name", F.lit(": empty frame, load refused")))
    verdict = F.when(F.col("row_count") > 0, F.lit("accepted")).otherwise(refused.cast("string"))
    return profile(frames).withColumn("validation", verdict)


def ingest_all(spark: SparkSession, source_dir: str, target_dir: str, *,
               files: Mapping[str, str] | None = None, id_type: str = "string",
               mode: str = "overwrite") -> DataFrame:
    """Read, validate and store all nine raw tables; returns their profile.

    ``files`` maps a logical table name to its file name under ``source_dir``
    (default ``<name>.csv``). A table is one pass: it is counted while it is written.
    The tables become the current ones of ``target_dir`` together, after the last; a
    failure raises and leaves those before in place.
    """
    load = TableStore(spark, target_dir).load()
    for name in RAW_TABLE_NAMES:
        fname = (files or {}).get(name, f"{name}.csv")
        df = read_raw_csv(spark, f"{source_dir.rstrip('/')}/{fname}", name, id_type=id_type)
        load.write(name, df, mode=mode, allow_empty=False)
    load.publish()
    rows = [(n, t.rows, len(t.schema), ",".join(t.schema.names)) for n, t in load.written.items()]
    return spark.createDataFrame(rows, "table_name string, row_count long, column_count long, column_names string")
