"""Fingerprints of texts as invertible Bloom lookup sketches of their paragraphs.

A text's paragraphs are its distinct sentences and lines, each hashed to 64 bits. A sketch has three
tables of cells; a paragraph adds to one cell of each: one to the count, its digest and a check to two
xors. Two sketches subtract cell by cell, so that what both texts share cancels, and peeling takes out
what differs: a cell of count one whose check fits holds a single digest, which then leaves its three
cells, and so on. The fingerprint is the smallest sketch (``TABLE`` cells a table). If peeling it fails,
the digests are dealt by hash into blocks of about ``BLOCK``, each sketched for itself, and blocks that
fail again are sketched with twice the cells, ``RETRIES`` times; what is still stuck is compared exactly.

Likeness is shared over all paragraphs (Jaccard), from the two counts and the number of digests peeled.

The neighbour of a document is the next by descending id. Ids are cut into ranges at quantiles, the head
of each range also goes to the range before it, and one shuffle brings documents and neighbours together.

Defined cases: null text is empty; a text without paragraphs has the zero sketch, and two such texts have
likeness 1; null ids come last; rows of equal id follow each other by their text's hash; a table of one
row is its own neighbour; an empty table gives an empty result; only id and text are carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLE, TABLES = 8, 3
BLOCK, RETRIES, ROUNDS = 8, 3, 20
#: Ends of paragraphs: line ends, and spaces after the end of a sentence.
ENDS = "\\n|(?<=[.!?])\\x20+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fold_xor(items: Column, of: Callable[[Column], Column], start: Column | None = None) -> Column:
    return F.aggregate(items, F.lit(0).cast("long") if start is None else start, lambda a, x: a.bitwiseXOR(of(x)))


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs of a text."""
    return F.array_distinct(F.transform(F.filter(F.split(text, ENDS), lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(99))


def _placed(key: Column, sign: Column, table: int | Column) -> Column:
    """A digest with its sign, check and cell in each table."""
    places = F.xxhash64(key, F.lit(table).cast("int"))
    cells = [F.pmod(F.shiftrightunsigned(places, 16 * t), F.lit(table)).cast("int").alias(f"p{t}") for t in range(TABLES)]
    return F.struct(key.alias("key"), sign.cast("int").alias("n"), _check(key).alias("check"), *cells)


def _hits(items: Column, table: int | Column, at: Column) -> Column:
    place = lambda x: F.when(at < table, x["p0"]).when(at < 2 * table, x["p1"] + F.lit(table)).otherwise(x["p2"] + F.lit(2 * table))
    return F.filter(items, lambda x: place(x) == at)


def sketch(digests: Column, table: int | Column = TABLE) -> Column:
    """The cells (n, key, check) of an array of digests."""
    cell = lambda h: F.struct(F.size(h).alias("n"), _fold_xor(h, lambda x: x["key"]).alias("key"), _fold_xor(h, lambda x: x["check"]).alias("check"))
    items = F.transform(digests, lambda d: _placed(d, F.lit(1), table))
    return _let(items, lambda v: F.transform(F.sequence(F.lit(0), F.lit(TABLES * table - 1)), lambda i: _let(_hits(v, table, i), cell)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(cells: Column, table: int | Column = TABLE) -> Column:
    """found (digests taken out) and whole (whether nothing is left) of a subtracted sketch."""
    pure = lambda cs: F.array_distinct(F.transform(F.filter(cs, lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))), lambda c: _placed(c["key"], c["n"], table)))

    def without(cs: Column, gone: Column) -> Column:
        return F.transform(
            cs,
            lambda c, i: _let(
                _hits(gone, table, i),
                lambda h: F.struct(
                    (c["n"] - F.aggregate(h, F.lit(0), lambda a, x: a + x["n"])).alias("n"),
                    _fold_xor(h, lambda x: x["key"], c["key"]).alias("key"),
                    _fold_xor(h, lambda x: x["check"], c["check"]).alias("check"),
                ),
            ),
        )

    def turn(s: Column, _: Column) -> Column:
        on = _let(
            pure(s["cells"]),
            lambda p: F.struct(
                F.when(F.size(p) > 0, without(s["cells"], p)).otherwise(s["cells"]).alias("cells"),
                (s["found"] + F.size(p)).alias("found"),
                (F.size(p) > 0).alias("moves"),
            ),
        )
        return F.when(s["moves"], on).otherwise(s)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("moves"))
    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    end = lambda s: F.struct(s["found"].alias("found"), F.forall(s["cells"], empty).alias("whole"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, end)


def _block_difference(a: Column, b: Column) -> Column:
    """Digests in one of two arrays only, by sketches of growing size."""
    sizes = F.array(*[F.lit(TABLE << k) for k in range(RETRIES + 1)])
    peeled = lambda table: peel(subtract(sketch(a, table), sketch(b, table)), table)
    attempt = lambda table: _let(peeled(table), lambda r: F.when(r["whole"], r["found"]).otherwise(F.lit(-1)))
    found = F.aggregate(sizes, F.lit(-1), lambda s, table: F.when(s >= 0, s).otherwise(attempt(table)))
    return _let(found, lambda n: F.when(n >= 0, n).otherwise(F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))))


def _dealt(digests: Column, parts: Column, shift: int) -> Column:
    """Arrays of the digests by a slice of their bits, ``parts`` of them."""
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.filter(digests, lambda d: F.pmod(F.shiftrightunsigned(d, shift), parts) == k))


def _differences(rows: DataFrame, others: dict[str, str]) -> DataFrame:
    """For each other array column its number of digests that it and ``a`` don't share, under a new name.

    Small sketches first; what they cannot peel is dealt into blocks, in two rounds, so that the work
    grows as n times the root of the number of blocks.
    """
    rows = rows.withColumns({f"small_{k}": peel(subtract(F.col("ca"), F.col(f"c{k}"))) for k in others})
    for k, name in others.items():
        side = F.greatest(F.lit(1), F.ceil(F.sqrt((F.size("a") + F.size(k)) / BLOCK)).cast("int"))
        rows = rows.withColumn("side", side)
        pairs = lambda x, y, shift: F.zip_with(_dealt(x, F.col("side"), shift), _dealt(y, F.col("side"), shift), lambda p, q: F.struct(p.alias("x"), q.alias("y")))
        rows = rows.withColumn("dealt", F.when(~F.col(f"small_{k}.whole"), F.flatten(F.transform(pairs(F.col("a"), F.col(k), 8), lambda p: pairs(p["x"], p["y"], 32)))))
        blocks = F.aggregate(F.transform("dealt", lambda q: _block_difference(q["x"], q["y"])), F.lit(0), lambda s, n: s + n)
        rows = rows.withColumn(name, F.when(F.col(f"small_{k}.whole"), F.col(f"small_{k}.found")).otherwise(blocks)).drop("side", "dealt")
    return rows


def likeness(a: Column, b: Column, differing: Column) -> Column:
    shared = (F.size(a) + F.size(b) - differing) / 2
    return F.when(shared + differing > 0, shared / (shared + differing)).otherwise(F.lit(1.0))


def sketch_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", c["n"], F.hex(c["key"]), F.hex(c["check"]))), " ")


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and next_text (of the next document by descending id; after the last, the first)."""
    spark = df.sparkSession
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [k / parts for k in range(1, parts + 1)]
    cuts = rows.agg(F.percentile_approx("key", at, 100 * parts).alias("cuts"), F.max("key").alias("top")).first()
    heads = sorted({*(cuts["cuts"] or []), cuts["top"] or 0}, reverse=True)
    table = F.split(F.lit(",".join(map(str, heads))), ",").cast("array<bigint>")

    def further(low: Column, step: Column) -> Column:
        return F.when(F.get(table, low + step) >= F.col("key"), low + step).otherwise(low)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(heads).bit_length()))])
    rows = rows.withColumn("range", F.aggregate(steps, F.lit(0), further))
    before = F.when(F.col("range") > 0, F.col("range") - 1).otherwise(len(heads) - 1)
    is_head = F.get(table, F.col("range")) == F.col("key")
    one = lambda r, guest: F.struct(r.alias("range"), F.lit(guest).alias("guest"))
    sent = F.when(is_head, F.array(one(F.col("range"), False), one(before, True))).otherwise(F.array(one(F.col("range"), False)))
    rows = rows.withColumn("sent", F.explode(sent)).select("doc_id", "text", "key", "sent.range", "sent.guest")
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), F.xxhash64("text"))
    return rows.withColumn("next_text", F.lead("text").over(order)).filter("NOT guest").select("doc_id", "text", "next_text")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last half replaced by as many characters of the next document's start.
    """
    rows = with_next(df, doc_id, text)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *[paragraphs(F.col(c)).alias(k) for c, k in (("text", "a"), ("edited", "e"), ("next_text", "x"))])
    rows = rows.withColumns({f"c{k}": sketch(F.col(k)) for k in "aex"})
    rows = _differences(rows, {"e": "de", "x": "dx"})
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        sketch_text(F.col("ca")).alias("fingerprint"),
        sketch_text(F.col("ce")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("e"), F.col("de")).alias("near_edited"),
        likeness(F.col("a"), F.col("x"), F.col("dx")).alias("near_next"),
    )
