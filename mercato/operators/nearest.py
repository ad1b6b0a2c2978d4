"""Nearest known key on a line, found ring by ring over a grid of cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RINGS = (10, 100, 1000)


def nearest_key(wanted: DataFrame, known: DataFrame, wanted_at: Column, known_at: Column, rings: Sequence[int] = RINGS) -> DataFrame:
    """Rows of ``wanted`` with the row of ``known`` whose number is nearest, as struct ``found``, and ``apart``.

    In a ring of width w the line is cut into cells of w; a wanted number meets the known ones of its own
    cell and the two beside it, which hold everything within w. What finds nothing within w goes on to
    the next ring. So a number meets at most 3 w known ones, in the width that its own gap asks for, and
    nothing is compared with all. Equal distances go to the smaller number. Nothing within the last ring,
    or no number: no row. ``known`` has one row a number; rows of ``wanted`` should be distinct.
    """
    left = wanted.select(F.struct(*wanted.columns).alias("row"), wanted_at.cast("long").alias("at")).filter("at IS NOT NULL")
    base = known.select(known_at.cast("long").alias("near"), F.struct(*known.columns).alias("found")).filter("near IS NOT NULL")
    parts = []
    for width in rings:
        cell = F.floor(F.col("near") / width)
        spread = base.select("near", "found", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
        met = left.withColumn("cell", F.floor(F.col("at") / width)).join(spread, "cell")
        met = met.withColumn("apart", F.abs(F.col("at") - F.col("near"))).filter(F.col("apart") <= width)
        best = met.groupBy("row", "at").agg(F.min_by("found", F.struct("apart", "near")).alias("found"), F.min("apart").alias("apart"))
        parts.append(best.select("row", "found", "apart"))
        left = left.join(best.select("row"), left["row"].eqNullSafe(best["row"]), "left_anti")
    every = reduce(DataFrame.unionByName, parts)
    return every.select("row.*", "found", "apart")
