"""Fingerprints against brute-force sets of paragraphs."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from mercato.llm.fingerprints import fingerprints
from mercato.llm.queries import op9_fingerprints


def brute(rows):
    rows = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    out = []
    for (i, t), (_, x) in zip(rows, rows[1:] + rows[:1], strict=True):
        h = len(t) // 2
        edited = t[: len(t) - h] + x[:h]
        a, e, n = (frozenset(p for p in re.split(r"\n|(?<=[.!?])\x20+", s) if p) for s in (t, edited, x))
        like = lambda b: len(a & b) / len(a | b) if a | b else 1.0  # noqa: E731, B023
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), like(e), like(n)))
    return out


def signed(t):
    h = xxhash.xxh64_intdigest(t.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[3:] == pytest.approx(w[3:])


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = op9_fingerprints(spark, "/root/testdata/sf0.01").collect()
    compare(rows, brute([(d.doc_id, d.text) for d in docs.collect()]))
    text = {d.doc_id: d.text for d in docs.collect()}
    by_text = {}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert r.near_edited < 1 or r.fingerprint == r.edited_fingerprint


def test_odd_rows(spark):
    long = ". ".join(f"sentence number {i}" for i in range(2500))
    rows = [(5, None), (4, ""), (4, ""), (None, "null id. One"), (7, "é. ñ! \n\n ü? x" * 5), (9, long), (8, long + ". end"), (-3, "A. " * 500), (2**62, "b"), (2, "same. text"), (1, "same. text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("range", F.lit(0)).withColumn("KEY", F.lit(""))
    compare(fingerprints(df.repartition(3)).collect(), brute(rows))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "x. y")], "doc_id long, text string")
    compare(fingerprints(one).collect(), brute([(1, "x. y")]))
    assert fingerprints(one.limit(0)).count() == 0
