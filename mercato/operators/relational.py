"""Relational building blocks.

Every operator here is a composition of DataFrame operations that Catalyst
plans with partial (map-side) aggregation, so a key that holds a large share of
the rows is combined before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` (nulls lowest).

    Remaining columns break exact ties, largest first. Spark limits every key to
    its first row before the shuffle (a window group limit), so a key with
    millions of rows sends one row a task, and wide columns such as comments
    travel for those rows only; no aggregate buffer holds them.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    order = [F.col(c).desc_nulls_last() for c in [*order_cols, *rest]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def using_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on shared key columns, kept once; keys missing on the right leave its columns null."""
    return left.join(right, list(keys), "left")


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def bucketize(value, edges: Sequence[float], labels: Sequence[str] | None = None,
              null_label: str | None = None) -> tuple[Column, Column, list[str]]:
    """Left-closed buckets ``[e_i, e_{i+1})`` with an open first and last bucket.

    Returns (label column, rank column starting at 1, label list). Null values
    fall into the last bucket, like a CASE chain whose ELSE catches them, or
    into a bucket of their own behind it when ``null_label`` names one.
    """
    edges = list(edges)
    if labels is None:
        bounds = [0] + edges
        labels = [f"{_fmt(a)}-{_fmt(b)}%" for a, b in zip(bounds, bounds[1:])] + [f"{_fmt(edges[-1])}%+"]
    v = _col(value)
    label = rank = None
    for i, e in enumerate(edges):
        cond = v < F.lit(e)
        label = F.when(cond, F.lit(labels[i])) if label is None else label.when(cond, F.lit(labels[i]))
        rank = F.when(cond, F.lit(i + 1)) if rank is None else rank.when(cond, F.lit(i + 1))
    label = label.otherwise(F.lit(labels[-1]))
    rank = rank.otherwise(F.lit(len(edges) + 1))
    if null_label is not None:
        label = F.when(v.isNull(), F.lit(null_label)).otherwise(label)
        rank = F.when(v.isNull(), F.lit(len(edges) + 2)).otherwise(rank)
        labels = [*labels, null_label]
    return label, rank, list(labels)


def _fmt(x) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def share_of_total(df: DataFrame, partition_cols: Sequence[str], value_col: str,
                   total_name: str) -> DataFrame:
    """Attach ``sum(value) over (partition by partition_cols)``.

    Used on pre-aggregated frames (a handful of rows per partition key).
    """
    w = Window.partitionBy(*partition_cols)
    return df.withColumn(total_name, F.sum(value_col).over(w))


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k, planned as a per-partition top-k plus a k-row merge."""
    return df.orderBy(*order).limit(k)


def topk_semi_join(df: DataFrame, ranked: DataFrame, key: str, order: Sequence[Column],
                   k: int) -> DataFrame:
    """Keep rows of ``df`` whose ``key`` is among the top ``k`` of ``ranked``.

    The top-k result has at most k rows, so broadcasting it is bounded by the
    parameter, not by the data.
    """
    top = topk(ranked, order, k).select(key)
    return df.join(F.broadcast(top), on=key, how="left_semi")
