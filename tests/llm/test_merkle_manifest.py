"""Manifest: leaves, roots, proofs and tampering against a plain tree."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mercato.llm.merkle_manifest import COLUMNS, FANOUT, folded, manifest, proof
from mercato.llm.queries import op13_merkle_manifest

DDL = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout):
    """Root, and the steps (left, right) of every node."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            run, slot = runs[i // fanout], i % fanout
            steps[k].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        nodes, at = [h(*run) for run in runs], [i // fanout for i in at]
    return nodes[0], steps


def expected(rows, lowered, fanout=FANOUT):
    """Rows (doc_id, leaf, subroot, root, proof, folded root)."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0], leaf_of(r), leaf_of((*r[:4], lowered(r)))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for s in order}
    subs = {s: tree([x[1] for x in trees[s]], fanout) for s in order}
    root, above = tree([subs[s][0] for s in order], fanout)
    out = []
    for s, up in zip(order, above, strict=True):
        for (doc_id, leaf, other), own in zip(trees[s], subs[s][1], strict=True):
            node = other
            for left, right in own + up:
                node = h(left, node, right)
            out.append((doc_id, leaf, subs[s][0], root, h(*[x for step in own + up for x in step]), node))
    return out


def found(df, fanout=FANOUT):
    low = F.translate("text", "ABC", "abc")
    rows = manifest(df, altered={"text": low}, fanout=fanout)
    return [tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("steps")), folded(F.col("altered_leaf"), F.col("steps"))).collect()]


def low(row):
    return None if row[4] is None else row[4].translate(str.maketrans("ABC", "abc"))


def key(row):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row)


ODD = [(1, None, None, None, None), (None, "a", "en", 3, "Axe"), (None, "a", "en", 3, "Axe"), (None, None, None, 0, ""), (7, "", "de", -5, "É:1"),
       (7, "", "de", -5, "É:1"), (7, "", "fr", 2, "BC"), (-3, "ä", "en", 1, "x" * 100_000), (2, "z", "en", 1, "c"), (3, "Z", "en", 1, "C")]


@pytest.mark.parametrize("fanout", [2, 3, FANOUT])
def test_matches_plain_tree(spark, fanout):
    rows = ODD + [(i * 7 % 300, f"s{i % 5 * (i % 3)}", "en", i, f"text {i} ABC") for i in range(300)]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    assert sorted(found(df, fanout), key=key) == sorted(expected(rows, low, fanout), key=key)


@pytest.mark.parametrize("n", [1, 2, FANOUT, FANOUT + 1, FANOUT**2 + 1])
def test_one_source(spark, n):
    """A lone leaf is root with no siblings; last runs of one node are hashed."""
    rows = [(i, "s", None, None, f"t{i}") for i in range(n)]
    got = found(spark.createDataFrame(rows, DDL))
    assert sorted(got) == sorted(expected(rows, low))
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h()


def test_many_sources(spark):
    rows = [(i, f"source-{i}", "en", 1, "B") for i in range(300)]
    assert sorted(found(spark.createDataFrame(rows, DDL))) == sorted(expected(rows, low))


def test_empty_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], DDL)) == []
    rows = [(1, "s", "en", 1, "A"), (2, "s", "en", 1, "B")]
    df = spark.createDataFrame(rows, DDL)
    wide = df.withColumns({c: F.lit(5) for c in ("leaf", "rank", "tree", "n", "first", "kids", "steps", "slot", "node", "other", "copy", "root", "_s")})
    assert sorted(found(wide)) == sorted(expected(rows, low))


def test_tampering_is_noticed(spark):
    got = op13_merkle_manifest(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    changed = docs.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").rlike("[A-Z]"))
    assert {r.doc_id for r in got.filter("NOT verified").select("doc_id").collect()} == {r.doc_id for r in changed.select("doc_id").collect()}
    assert got.select("root").distinct().count() == 1 and set(COLUMNS) == set(docs.columns)
