"""Exact distinct counts at several calendar levels from one mergeable state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = 60  # months in one state word: five whole years in a long


def _level(name: str, first_month: Column) -> Column:
    return F.struct(F.lit(name).alias("level"), first_month.cast("date").alias("period"))


def distinct_rollup(df: DataFrame, keys: Sequence[str], member: str, month: str,
                    count_name: str = "members") -> DataFrame:
    """Distinct values of ``member`` per ``keys``: for each month, for each year and for all time.

    Distinct counts of months don't add up to those of a year, so the state that is merged is the set
    of months in which a member occurs: one bit a month, ``WORD`` months to a long. Words of one member
    are merged with ``bit_or``, before the shuffle too, so a key that holds a third of all rows moves one
    row a member and word, and is spread over tasks by member. Every level is read off the same words:
    a month by its bit, a year by its twelve bits, all time by a member's first word.

    Columns: ``keys``, ``level`` (month, year or all), ``period`` (first day of it; null for all) and
    ``count_name``. A null key is a key. Null members are not counted, and a group without any other gives
    no row. A row without a month counts for all time only.
    """
    number = F.year(month) * F.lit(12) + F.month(month) - F.lit(1)
    words = (df.where(F.col(member).isNotNull())
             .select(*keys, F.col(member).alias("__member"), number.alias("__number"))
             .withColumn("__bit", F.pmod("__number", F.lit(WORD)))
             .withColumn("__base", F.col("__number") - F.col("__bit"))
             .groupBy(*keys, "__member", "__base")
             .agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits")))
    # at most one row a word of the calendar in a window partition
    by_member = Window.partitionBy(*keys, "__member").orderBy("__base")
    first = words.withColumn("__first", F.row_number().over(by_member) == 1)

    def day(offset: Column) -> Column:
        n = F.col("__base") + offset
        return F.make_date(F.floor(n / 12).cast("int"), F.pmod(n, F.lit(12)) + 1, F.lit(1))

    def has(bits: Column) -> Column:
        return F.col("__bits").bitwiseAND(bits) != 0

    months = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)),
                      lambda i: has(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    years = F.filter(F.sequence(F.lit(0), F.lit(WORD - 12), F.lit(12)),
                     lambda i: has(F.call_function("shiftleft", F.lit(4095).cast("long"), i)))
    whole = F.when(F.col("__first"), F.array(_level("all", F.lit(None)))).otherwise(
        F.array().cast("array<struct<level:string,period:date>>"))
    found = F.concat(F.coalesce(F.transform(months, lambda i: _level("month", day(i))),
                                F.array().cast("array<struct<level:string,period:date>>")),
                     F.coalesce(F.transform(years, lambda i: _level("year", day(i))),
                                F.array().cast("array<struct<level:string,period:date>>")),
                     whole)
    return (first.select(*keys, F.inline(found))
            .groupBy(*keys, "level", "period").agg(F.count(F.lit(1)).alias(count_name)))
