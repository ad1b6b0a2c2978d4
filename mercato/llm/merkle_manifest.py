"""Merkle manifest of a dataset: one tree a source, one tree over the sources' roots.

A leaf is the digest of a row's columns. Leaves of a source ascend by id; every ``FANOUT`` consecutive
nodes become one. A level is one grouping by parent: conditional aggregates spread the children into
fanout columns, and the concatenated columns are what is hashed. A level has a sixteenth of the rows of
the one below, so after the first everything is small.

Proofs come down again, joined parent to children: a child's step holds the columns left and right of
its own slot. Steps above the first level are shared by a group of leaves and meet the leaves only in the
group's row, so no leaf is shuffled for its proof.

Places within a source come from one global rank over (source, id, leaf, copy): ranges of that order are
dealt to tasks, so a source that holds a third of all rows is split like any other.

Defined cases: null columns count as ``-``; rows without a source form a source of their own, the first;
null ids come first; equal ids are ordered by their leaves, equal leaves are interchangeable; a source
of one row has its leaf as subroot; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written
from mercato.operators.ranking import global_rank

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A column's form in a leaf: byte count and value, ``-`` for null."""
    said = value.cast("string")
    return F.when(said.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))


def leaf(columns: list[Column]) -> Column:
    return digest(*map(field, columns))


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _level(nodes: DataFrame, fanout: int) -> DataFrame:
    """tree, parent, n (nodes of the tree on the children's level) and kids, one row a parent."""
    parent, slot = F.floor(F.col("idx") / fanout), F.col("idx") % fanout
    columns = [F.max(F.when(slot == k, F.col("node"))).alias(f"c{k}") for k in range(fanout)]
    spread = nodes.groupBy("tree", parent.alias("parent")).agg(F.max("n").alias("n"), *columns)
    return spread.select("tree", "parent", "n", F.array_compact(F.array(*[f"c{k}" for k in range(fanout)])).alias("kids"))


def _parents(level: DataFrame, fanout: int, node: Column) -> DataFrame:
    """The nodes a level up; the only node of a tree stays what it is."""
    up = F.when(F.col("n") > 1, F.sha2(_joined(node).cast("binary"), 256)).otherwise(node[0])
    return level.select("tree", F.col("parent").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"), up.alias("node"))


def _height(most: int | None, fanout: int) -> int:
    """Levels above the leaves of a tree with so many of them; one at least."""
    levels, n = 1, -(-(most or 0) // fanout)
    while n > 1:
        levels, n = levels + 1, -(-n // fanout)
    return levels


def _children(level: DataFrame, above: DataFrame, fanout: int, digests: Column) -> DataFrame:
    """The level's children: tree, idx, kid, and their steps, own one first, then their parent's."""
    keyed = above.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), "steps", "subroot", "root")
    both = level.join(keyed, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_i"))).withColumn("digests", digests)
    each = both.select("*", F.posexplode("kids").alias("slot", "kid"))
    left = _joined(F.slice("digests", F.lit(1), F.col("slot")))
    right = _joined(F.slice("digests", F.col("slot") + 2, F.lit(fanout)))
    own = F.when(F.col("n") > 1, F.array(F.struct(left.alias("left"), right.alias("right"))))
    steps = F.concat(F.coalesce(own, F.slice("steps", 1, 0)), F.col("steps"))
    return each.select("tree", (F.col("parent") * fanout + F.col("slot")).alias("idx"), "kid", steps.alias("steps"), "subroot", "root")


def proof(steps: Column) -> Column:
    """Digest of all siblings on the way to the root, left to right, level by level."""
    return F.sha2(_joined(F.transform(steps, lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf leads to with the siblings of ``steps``."""
    return F.aggregate(steps, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", columns: tuple[str, ...] = COLUMNS,
             altered: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """Every row's doc_id, source, leaf, altered_leaf, steps, subroot and root.

    ``altered`` gives other values for some columns; altered_leaf is the digest with them, to be held
    against the tree of the original rows. ``steps``: array of (left, right), the siblings' digests.
    """
    changed = altered or {}
    other = leaf([changed.get(c, F.col(c)) for c in columns]) if changed else F.lit(None).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), leaf([F.col(c) for c in columns]).alias("leaf"),
                       other.alias("other"), F.monotonically_increasing_id().alias("copy"))
    rows = written(rows, "leaves")
    ranked = global_rank(rows, ["source", "doc_id", "leaf", "copy"])
    trees = written(ranked.groupBy("source").agg((F.min("rank") - 1).alias("first"), F.count("*").alias("n")), "trees")
    trees = written(global_rank(trees, ["first"], rank_col="tree"), "trees")
    size = trees.agg(F.max("n").alias("most"), F.count("*").alias("n")).first()

    own = trees.withColumnRenamed("source", "_s")
    placed = ranked.join(own, F.col("source").eqNullSafe(F.col("_s")))
    node = F.struct("leaf", F.coalesce("other", "leaf").alias("other"), "doc_id", "source")
    nodes = placed.select("tree", (F.col("rank") - 1 - F.col("first")).alias("idx"), "n", node.alias("node"))
    leaves = F.transform("kids", lambda k: k["leaf"])

    levels = [written(_level(nodes, fanout), "level")]
    nodes = _parents(levels[0], fanout, leaves)
    for _ in range(_height(size["most"], fanout) - 1):
        levels.append(written(_level(nodes, fanout), "level"))
        nodes = _parents(levels[-1], fanout, F.col("kids"))

    # one node a tree is left; the trees' nodes are the leaves of the last tree
    nodes = nodes.select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("idx"), F.lit(size["n"]).alias("n"), "node")
    tops = []
    for _ in range(_height(size["n"], fanout)):
        tops.append(written(_level(nodes, fanout), "level"))
        nodes = _parents(tops[-1], fanout, F.col("kids"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    above = nodes.select("tree", "idx", none.alias("steps"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for level in reversed(tops):
        above = _children(level, above, fanout, F.col("kids")).withColumn("subroot", F.col("kid"))
    above = above.select((F.col("idx") + 1).alias("tree"), F.lit(0).cast("long").alias("idx"), "steps", "subroot", "root")
    for level in reversed(levels[1:]):
        above = _children(level, above, fanout, F.col("kids"))
    out = _children(levels[0], above, fanout, leaves)
    return out.select("kid.doc_id", "kid.source", "kid.leaf", F.col("kid.other").alias("altered_leaf"), "steps", "subroot", "root")
