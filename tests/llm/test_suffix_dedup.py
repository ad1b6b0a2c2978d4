"""Repeated strings against brute force over all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mercato.llm.queries import op3_suffix_dedup
from mercato.llm.suffix_dedup import remove_repeats


def brute(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        k = (i is None, i or 0)
        for s in range(len(b) - 49):
            w = b[s : s + 50]
            first[w] = min(first.get(w, k), k)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < (i is None, i or 0):
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), bytes(gone).replace(b"\0", b" ").split().__len__(), hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(((r[0] is None, r[0] or 0, *tuple(r)[1:5]) for r in rows))


def same(got, rows):
    assert order(got) == order(brute(rows))


def made(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aábcdé") for _ in range(rng.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randrange(8, 60))) for _ in range(8)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(40)))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            parts += [p[a:b], word()]
        texts.append(" ".join(parts))
        if rng.random() < 0.3:
            t = list(rng.choice(texts))
            if t:
                t[rng.randrange(len(t))] = "#"
            texts.append("".join(t))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    texts = made(seed)
    texts += ["x" * 49, "x" * 50, "x" * 400, "ab" * 60, "ab" * 300, "\0" * 120, "\0" * 90 + "z", None, "", texts[0], texts[0]]
    rng = random.Random(seed)
    ids = list(range(-5, len(texts) - 5))
    rng.shuffle(ids)
    rows = [*zip(ids, texts, strict=True), (None, texts[0]), (None, texts[1]), (ids[3], texts[3]), (ids[4], texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("x"))
    for size in (1 << 22, 2000):
        same(remove_repeats(df.repartition(6), chunk_bytes=size).collect(), rows)


def test_query_and_kept_text(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = op3_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    same(got, rows)
    assert any(r.n_removed for r in got)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in remove_repeats(df, with_kept=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert remove_repeats(df.limit(0)).count() == 0
