"""CSV with quoted newlines, read by many tasks a file.

Spark's ``multiLine`` reads a file in one task, for only the whole file's quotes tell whether a line end
lies within a value. Here every physical line is a row, found by whichever task reads its split, and

1. a line's quotes are folded twice, for a start outside of quotes and for one inside: what is kept is
   whether the next line is then inside. That is a function on two states: same, turned, or fixed;
2. the functions are composed along each split (running counts, split by split), then along the file's
   splits (one row each), which gives every split the state it starts in;
3. a line that starts outside opens a record. Records of one line are parsed where they are; the lines of
   longer ones meet by the number of the line that opened them, across splits if need be.

The rules for quotes are those of the parser: a value is quoted if its first character is a quote, a
doubled quote stands for one, quotes elsewhere are plain characters. A file whose first line ends in CR LF
has its CR LF taken as one line end everywhere, in values too. A file that ends within quotes raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# where a character of a record stands: first of a value, in a plain value, in quotes, behind a quote in
# quotes, behind the closing quote
START, PLAIN, QUOTED, QUOTE, CLOSED = range(5)
PARSE = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def _either(state: Column, cases: dict[int, Column | int], other: Column | int) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return reduce(lambda out, k: out.when(state == k, lit(cases[k])), list(cases)[1:], F.when(state == list(cases)[0], lit(cases[list(cases)[0]]))).otherwise(lit(other))


def _past_text(state: Column, part: Column) -> Column:
    """The state behind a stretch without quotes."""
    outside = F.when(F.endswith(part, F.lit(",")), START).when(F.contains(part, F.lit(",")), PLAIN).otherwise(
        F.when(state.isin(QUOTE, CLOSED), CLOSED).otherwise(PLAIN))
    return F.when((part == "") | (state == QUOTED), state).otherwise(outside)


def _past_quote(state: Column) -> Column:
    return _either(state, {START: QUOTED, QUOTED: QUOTE, QUOTE: QUOTED}, state)


def _inside_after(line: Column, start: int) -> Column:
    """Whether a line leaves the next one inside quotes, if it starts in a state itself."""
    parts = F.split(line, '"')
    before = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(start), lambda s, p: _past_quote(_past_text(s, p)))
    last = _past_text(before, F.element_at(parts, -1)) == QUOTED
    return F.when(F.contains(line, F.lit('"')), last).otherwise(F.lit(start == QUOTED))


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """file, split, at (ascending within a split, unique), line, whether it ends in CR, and where it leads from outside and from inside."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select("file", "split", "at", text.alias("line"))
    return lines.withColumns({"cr": F.endswith("line", F.lit("\r")), "outer": _inside_after(F.col("line"), START), "inner": _inside_after(F.col("line"), QUOTED)})


def _composed(df: DataFrame, over: Window) -> DataFrame:
    """Running composition of the functions (outer, inner): ``fixed`` state or null, and whether it is ``turned`` since."""
    rows = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = df.withColumn("turns", F.count_if(F.col("outer") & ~F.col("inner")).over(rows))
    is_fixed = F.col("outer") == F.col("inner")
    last = turns.withColumn("last", F.last(F.when(is_fixed, F.struct("outer", "turns")), ignorenulls=True).over(rows))
    since = F.col("turns") - F.coalesce(F.col("last.turns"), F.lit(0))
    return last.withColumns({"fixed": F.col("last.outer"), "turned": since % 2 == 1}).drop("turns", "last")


def _led(fixed: Column, turned: Column, start: Column) -> Column:
    """The state that a composed function leads to."""
    return F.coalesce(fixed, start) != turned


def _before(over: Window) -> tuple[Column, Column]:
    return F.lag("fixed").over(over), F.coalesce(F.lag("turned").over(over), F.lit(False))


def _split_starts(lines: DataFrame) -> DataFrame:
    """file, split, start (inside quotes or not), owner (the line that opened the record the split starts in), and the file's crlf."""
    here = Window.partitionBy("file", "split").orderBy("at")
    steps = _composed(lines.drop("line"), here)
    fixed, turned = _before(here)
    steps = steps.withColumns({"at_outer": F.when(~_led(fixed, turned, F.lit(False)), F.col("at")), "at_inner": F.when(~_led(fixed, turned, F.lit(True)), F.col("at"))})
    last, first = F.max(F.struct("at", "fixed", "turned")).alias("end"), F.min(F.struct("at", "cr")).alias("begin")
    splits = steps.groupBy("file", "split").agg(last, first, F.max("at_outer").alias("at_outer"), F.max("at_inner").alias("at_inner"))
    splits = splits.select("file", "split", "at_outer", "at_inner", "begin.cr", *[_led(F.col("end.fixed"), F.col("end.turned"), F.lit(s)).alias(n) for n, s in (("outer", False), ("inner", True))])

    along = Window.partitionBy("file").orderBy("split")  # one row a split
    whole = _composed(splits, along).withColumn("ends", _led(F.col("fixed"), F.col("turned"), F.lit(False)))
    unclosed = F.lead("split").over(along).isNull() & F.col("ends")
    start = F.coalesce(F.lag("ends").over(along), F.lit(False))
    start = F.when(unclosed, F.raise_error(F.concat(F.lit("file ends within quotes: "), F.col("file")))).otherwise(start)
    own = whole.withColumn("start", start).withColumn("opened", F.when(F.col("start"), F.col("at_inner")).otherwise(F.col("at_outer")))
    owner = F.last("opened", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    return own.select("file", "split", "start", owner.alias("owner"), F.first("cr").over(along).alias("crlf"))


def records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The records of the files as text: record, file and whether it is the file's first."""
    lines = _lines(spark, path, encoding)
    here = Window.partitionBy("file", "split").orderBy("at")
    rows = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = _composed(lines.drop("cr"), here).join(_split_starts(lines), ["file", "split"])
    before = _before(here)
    opens, ends = ~_led(*before, F.col("start")), ~_led(F.col("fixed"), F.col("turned"), F.col("start"))
    marked = marked.select("file", "split", "at", "line", "crlf", opens.alias("opens"), ends.alias("ends"),
                           F.coalesce(F.last(F.when(opens, F.col("at")), ignorenulls=True).over(rows), F.col("owner")).alias("record_at"),
                           ((F.col("split") == 0) & (F.row_number().over(here) == 1)).alias("first"))
    short = marked.filter("opens AND ends").select("line", "file", "first", "crlf")
    parts = marked.filter("NOT (opens AND ends)").groupBy("file", "record_at").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("parts"), F.max("first").alias("first"), F.max("crlf").alias("crlf"))
    long = parts.select(F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("line"), "file", "first", "crlf")
    text = F.when(F.col("crlf"), F.replace(F.regexp_replace("line", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("line"))
    return short.union(long).select(text.alias("record"), "file", "first")


def read_split_csv(spark: SparkSession, path: str, schema: StructType, *, encoding: str = "UTF-8") -> DataFrame:
    """Rows of CSV files with a header line; any value may hold quoted line ends. Malformed records raise."""
    found = records(spark, path, encoding)
    names = F.split(F.regexp_replace(F.regexp_replace("record", "^﻿", ""), '"', ""), ",")
    wanted = F.array(*[F.lit(n) for n in schema.names])
    wrong = F.raise_error(F.concat(F.lit("header does not match the schema: "), F.col("record")))
    body = found.filter(F.when(~F.col("first"), F.col("record") != "").when(names == wanted, F.lit(False)).otherwise(wrong.cast("boolean")))
    return body.select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), PARSE).alias("row")).select("row.*")
