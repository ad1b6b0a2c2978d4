"""Global rank, running sum and ntile without a single-partition window.

``row_number() over (order by ...)`` with no PARTITION BY makes Spark move every row into one task.
Here the input is range-partitioned on the sort columns and written once to the shared scratch folder
with the number of its partition; each partition is ranked on its own, and the offsets of the partitions
before it (one row a partition) are added back. There is one path for every size: the number of
partitions is Spark's own, sized by adaptive execution.

Requirements: one direction for all sort columns (ASC = nulls first, DESC = nulls last, Spark's
defaults) and a unique last column (the tie-breaker), so ranks are deterministic and equal leading
values do not pile up in one range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import scratch_path


def write_scratch_table(df: DataFrame, prefix: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back (lineage cut)."""
    path = scratch_path(df.sparkSession, prefix)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, order_cols: Sequence[str], *, descending: bool = False,
                rank_col: str = "rank", running_sum: str | None = None,
                running_col: str = "running_sum", total_count_col: str | None = None,
                total_sum_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``rank_col`` over ``order_cols`` (optionally a running sum).

    ``total_count_col`` / ``total_sum_col`` attach ``count(*) over ()`` and ``sum(running_sum) over ()``.
    ``partitions`` fixes the number of ranges; by default Spark chooses.
    """
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    ranges = df.repartitionByRange(partitions, *sort) if partitions else df.repartitionByRange(*sort)
    staged = write_scratch_table(ranges.withColumn("_gr_range", F.spark_partition_id()), "ranges")

    aggs = [F.count(F.lit(1)).alias("_gr_n")]
    if running_sum:
        aggs.append(F.sum(running_sum).alias("_gr_s"))
    per_range = staged.groupBy("_gr_range").agg(*aggs)
    before = Window.orderBy("_gr_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = per_range.select(
        "_gr_range",
        F.coalesce(F.sum("_gr_n").over(before), F.lit(0)).alias("_gr_n_before"),
        F.sum("_gr_n").over(everything).alias("_gr_n_total"),
        *([F.sum("_gr_s").over(before).alias("_gr_s_before"),
           F.sum("_gr_s").over(everything).alias("_gr_s_total")] if running_sum else []))

    w = Window.partitionBy("_gr_range").orderBy(*sort)
    out = staged.withColumn("_gr_local_rank", F.row_number().over(w))
    if running_sum:
        here = w.rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("_gr_local_sum", F.sum(running_sum).over(here))
    # one row a partition of the ranges: as many as Spark has shuffle partitions, whatever the data
    out = out.join(F.broadcast(offsets), "_gr_range")
    out = out.withColumn(rank_col, (F.col("_gr_n_before") + F.col("_gr_local_rank")).cast("bigint"))
    if running_sum:
        out = out.withColumn(running_col, F.when(F.col("_gr_s_before").isNull(), F.col("_gr_local_sum"))
                             .otherwise(F.col("_gr_s_before") + F.col("_gr_local_sum")))
    if total_count_col:
        out = out.withColumn(total_count_col, F.col("_gr_n_total").cast("bigint"))
    if total_sum_col and running_sum:
        out = out.withColumn(total_sum_col, F.col("_gr_s_total"))
    return out.drop(*[c for c in out.columns if c.startswith("_gr_")])


def global_ranks(df: DataFrame, orders: Mapping[str, tuple[Sequence[str], bool]], key: Sequence[str], *,
                 total_count_col: str | None = None) -> DataFrame:
    """Add one 1-based rank per order, all from one range shuffle and one staged write.

    ``orders`` maps a rank's name to (columns, descending); ``key`` names a row uniquely and ends every
    order. Each row is dealt once an order, with that order's columns only (the row itself travels with
    the first); the ranges of all orders are bounds of one sort, in which an order's columns are null for
    the rows of the others. Ranks meet their rows again by ``key``.
    """
    fields = {c: df.schema[c].dataType.simpleString() for c in df.columns}
    places = [(i, c) for i, (cols, _) in enumerate(orders.values()) for c in cols]

    def copy(i: int) -> Column:
        at = [(F.col(c) if j == i else F.lit(None).cast(fields[c])).alias(f"k{n}") for n, (j, c) in enumerate(places)]
        row = F.struct(*df.columns)
        return F.struct(F.lit(i).alias("o"), F.struct(*key).alias("id"), (row if i == 0 else F.when(F.lit(False), row)).alias("row"), *at)

    dealt = df.select(F.inline(F.array(*[copy(i) for i in range(len(orders))])))
    down = [d for _, d in orders.values()]
    sort = [F.col("o")] + [F.col(f"k{n}").desc() if down[j] else F.col(f"k{n}").asc() for n, (j, _) in enumerate(places)]
    staged = write_scratch_table(dealt.repartitionByRange(*sort).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("o").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy("o", "range").count().select(
        "o", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"),
        F.sum("count").over(Window.partitionBy("o")).alias("total"))
    # one row an order and partition of the ranges, whatever the data
    local = staged.withColumn("local", F.row_number().over(Window.partitionBy("o", "range").orderBy(*sort)))
    ranked = local.join(F.broadcast(offsets), ["o", "range"])
    rank = F.col("before") + F.col("local")
    back = ranked.groupBy("id").agg(F.any_value("row", ignoreNulls=True).alias("row"), F.max("total").alias("total"),
                                    *[F.max(F.when(F.col("o") == i, rank)).cast("bigint").alias(f"r{i}") for i in range(len(orders))])
    total = [F.col("total").cast("bigint").alias(total_count_col)] if total_count_col else []
    return back.select("row.*", *[F.col(f"r{i}").alias(name) for i, name in enumerate(orders)], *total)


def ntile_from_rank(rank: Column | str, total: Column | str, n: int) -> Column:
    """``ntile(n)`` from a 1-based rank and the row count (first buckets get the extra rows)."""
    r = F.col(rank) if isinstance(rank, str) else rank
    t = F.col(total) if isinstance(total, str) else total
    q = F.floor(t / n)
    rem = t - q * n
    big = q + 1
    tile = F.when(q == 0, r).when(r <= rem * big, F.floor((r - 1) / big) + 1) \
        .otherwise(rem + F.floor((r - 1 - rem * big) / F.when(q == 0, 1).otherwise(q)) + 1)
    return tile.cast("bigint")
