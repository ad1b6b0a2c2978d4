"""Sinks: tables (parquet / catalog), views, and SQL over registered views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Write dispositions of a warehouse load job and their Spark save modes.
WRITE_MODES = {
    "WRITE_TRUNCATE": "overwrite",
    "WRITE_APPEND": "append",
    "WRITE_EMPTY": "append",
    "overwrite": "overwrite",
    "append": "append",
    "errorifexists": "errorifexists",
}


def write_table(df: DataFrame, target: str, *, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, fmt: str = "parquet",
                path: str | None = None, as_catalog_table: bool = False) -> str:
    """Write ``df`` to a path, or to a catalog table ``namespace.table`` (its namespace is made if absent).

    WRITE_EMPTY loads a table that is absent or has no rows and raises otherwise. ``path``: where a
    catalog table keeps its files. Errors propagate.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    if mode == "WRITE_EMPTY":
        held = _held(spark, target, fmt, as_catalog_table)
        if held is not None and not held.isEmpty():
            raise ValueError(f"{target} already holds rows")
    writer = df.write.mode(WRITE_MODES[mode]).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not as_catalog_table:
        writer.save(target)
        return target
    if "." in target:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target.rpartition('.')[0]}`")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(target)
    return target


def _held(spark: SparkSession, target: str, fmt: str, as_catalog_table: bool) -> DataFrame | None:
    """The rows of a target that exists."""
    if as_catalog_table:
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return spark.read.format(fmt).load(target)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a written table back; ``like`` restores exact types and column order."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """Run SQL against registered views; returns a lazy DataFrame (never collected)."""
    return spark.sql(query)
