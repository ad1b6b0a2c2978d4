"""Rule-based quality filter with a hashed n-gram likelihood ratio as the final verdict.

Each word, and with ``order`` 2 each pair of neighbouring words, is hashed into one of ``buckets`` cells
of its kind. Two multinomials a kind are counted over whole tables, one over the trusted target texts and
one over the raw corpus, both with add-one smoothing. A document's score is the mean of
``log p_target(cell) - log p_raw(cell)`` over its words and pairs, so it does not depend on length. Words
alone cannot tell a text from the same words in another order; op8 and the pipeline use ``ORDER``. A fixed
threshold decides every document: no sampling, no randomness.

Defined cases: null text has no words; a document without words scores 0; without any trusted text
every score is 0. Ties, repeated rows and other columns do not matter: each row is scored alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import GAP_CHARS, private, shuffles_removed, words

BUCKETS = 1 << 15
#: Words and pairs; ``PAIR_THRESHOLD`` is set for their score, ``THRESHOLD`` for that of words alone.
ORDER = 2
THRESHOLD = -0.3
PAIR_THRESHOLD = -0.15
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8


def _cell(hashed: Column, buckets: int) -> Column:
    return hashed.bitwiseAND(F.lit(buckets - 1)) if buckets & (buckets - 1) == 0 else F.pmod(hashed, F.lit(buckets))


def _joined(hashes: Column, width: int) -> Column:
    """Hashes of runs twice as long, ``hashes`` being those of the runs of ``width`` words."""
    return F.zip_with(hashes, F.slice(hashes, width + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def _pairs(two: Column) -> Column:
    """The run of two that starts at the last word is none."""
    return F.slice(two, 1, F.greatest(F.size(two) - 1, F.lit(0)))


def likelihood_ratios(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, order: int = 1) -> list[float]:
    """Log ratio of each cell (words, then pairs): the trusted documents against all documents.

    ``labels`` (doc_id, quality) mark trusted documents with quality 1; of several labels the best
    counts. Documents travel to their labels as two bytes a word or pair; counts are combined per cell
    before their shuffle, and exactly ``buckets`` numbers a kind reach the driver whatever the corpus
    holds. The join is by sorted ids at every size, so that its cost grows with the table alone.
    """
    if not 0 < buckets <= 1 << 15:
        raise ValueError("buckets must fit two bytes")
    if order not in (1, 2):
        raise ValueError("order must be 1 or 2")
    trust = labels.groupBy(F.col("doc_id").alias("label_id")).agg((F.max("quality") == 1).cast("int").alias("trusted"))
    each = docs.select(F.col(doc_id).alias("own_id"), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("one"))
    cells = F.transform("one", lambda h: _cell(h, buckets).cast("smallint"))
    if order == 2:  # the cells of pairs are the negative numbers
        each = each.withColumn("two", _joined(F.col("one"), 1))
        cells = F.concat(cells, F.transform(_pairs(F.col("two")), lambda h: (F.lit(-1) - _cell(h, buckets)).cast("smallint")))
    each = each.select("own_id", cells.alias("cells")).join(trust.hint("merge"), F.col("own_id") == F.col("label_id"), "left")
    # the outer form: for the plain one Spark infers a filter on the array's size, which computes all cells twice
    each = each.select(F.coalesce("trusted", F.lit(0)).alias("t"), F.explode_outer("cells").alias("cell")).where("cell IS NOT NULL")
    with shuffles_removed(docs.sparkSession):
        counts = {r.cell: (r.target, r.raw) for r in each.groupBy("cell").agg(F.sum("t").alias("target"), F.count("*").alias("raw")).collect()}
    out: list[float] = []
    for own in (range(buckets), range(-1, -1 - buckets, -1))[:order]:
        found = [counts.get(i, (0, 0)) for i in own]
        all_target, all_raw = (sum(c[k] for c in found) for k in (0, 1))
        shift = math.log(all_raw + buckets) - math.log(all_target + buckets)
        out += [math.log(target + 1) - math.log(raw + 1) + shift if all_target else 0.0 for target, raw in found]
    return out


def _score(kinds: list[Column], ratios: list[float]) -> Column:
    """Mean ratio; ``kinds``: the hashes of words, then of pairs, with as many ratios for each."""
    buckets = len(ratios) // len(kinds)

    def add(total: Column, hashes: Column, own: list[float]) -> Column:
        table = F.split(F.lit(",".join(map(repr, own))), ",").cast("array<double>")  # folded to one literal
        return F.aggregate(hashes, total, lambda a, h: a + F.get(table, _cell(h, buckets).cast("int")))

    total, size = F.lit(0.0), F.lit(0)
    for k, hashes in enumerate(kinds):
        total, size = add(total, hashes, ratios[k * buckets : (k + 1) * buckets]), size + F.size(hashes)
    return F.when(size > 0, total / size).otherwise(F.lit(0.0))


def _covered(ordered: Column) -> Column:
    """Words inside windows that occur more than once; ``ordered``: a column of sorted (hash, start)."""
    neighbour = lambda x, k: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter(ordered, lambda x, k: neighbour(x, k - 1) | neighbour(x, k + 1)), lambda x: x["i"]))

    def grow(a, i):
        upto = i + WINDOW
        return F.struct((a["n"] + (upto - F.greatest(a["to"], i)).cast("long")).alias("n"), upto.alias("to"))

    return F.aggregate(starts, F.expr("named_struct('n', 0L, 'to', 0)"), grow, lambda a: a["n"])


def quality_features(df: DataFrame, text: str = "text", ratios: list[float] | None = None, order: int = 1) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and llr added."""
    body, own, rows, hashes, two, wins, ordered = private(df, "_body", "_own", "_rows", "_hashes", "_two", "_wins", "_ordered")
    # Strings and their arrays are dropped where they are last read: every later projection would copy them.
    out = df.withColumns({body: F.coalesce(F.col(text), F.lit("")), own: words(F.col(text))})
    t, h = F.col(body), F.col(hashes)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "")
    out = out.withColumns(
        {
            "word_chars": F.length(F.array_join(own, "")).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"),
            hashes: F.transform(own, lambda w: F.xxhash64(w)),
            rows: F.when(F.instr(t, "\n") > 0, lines),
        }
    ).drop(body, own)
    repeated_lines = F.when(F.col(rows).isNotNull(), F.size(rows) - F.size(F.array_distinct(rows))).otherwise(0).cast("long")
    out = out.withColumns({"n_words": F.size(h).cast("long"), "n_dup_lines": repeated_lines, two: _joined(h, 1)}).drop(rows)
    # hashes of the runs of four, then eight words that start at each word
    eight = F.element_at(F.transform(F.array(_joined(F.col(two), 2)), lambda four: _joined(four, 4)), 1)
    eight = F.when(F.size(h) >= WINDOW, F.slice(eight, F.lit(1), F.size(h) - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>"))
    llr = _score([h, _pairs(F.col(two))][:order], ratios) if ratios is not None else F.lit(0.0)
    out = out.withColumns({wins: eight, "llr": llr}).drop(hashes, two)
    wn = F.col(wins)
    pairs = F.transform(wn, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn(ordered, F.when(F.size(F.array_distinct(wn)) < F.size(wn), F.sort_array(pairs))).drop(wins)
    repeated = F.when(F.col(ordered).isNotNull(), _covered(F.col(ordered))).otherwise(F.lit(0).cast("long"))
    out = out.withColumn("n_repeat_words", repeated).drop(ordered)
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def quality_rules(df: DataFrame, ratios: list[float], text: str = "text", threshold: float | None = None, order: int = 1) -> DataFrame:
    """Features and verdict: kept is false if base_failed, else whether llr reaches ``threshold`` (None: that of ``order``)."""
    if threshold is None:
        threshold = THRESHOLD if order == 1 else PAIR_THRESHOLD
    return quality_features(df, text, ratios, order).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
