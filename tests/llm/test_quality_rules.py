"""Quality rules against a brute-force version."""

import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from mercato.llm.quality_rules import ORDER, likelihood_ratios, quality_rules

GAP = re.compile("[\x20\x09-\x0d]+")


def brute(text, ratios):
    text = text or ""
    w = [x for x in GAP.split(text) if x]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, dup, old = [x for x in text.split("\n") if GAP.sub("", x)], 0, set()
    for x in lines:
        dup += x in old
        old.add(x)
    total = sum(ratios[_pmod(xxhash.xxh64_intdigest(x.encode(), 42), len(ratios))] for x in w)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed), total / len(w) if w else 0.0


def _pmod(h, n):
    return (h - (1 << 64) if h >= 1 << 63 else h) % n


CASES = [None, "", "   \n\t", "one", "a b c d e f g h " * 3, "x\ny\nx\n \n\nx", "é ñ #*$ |<>&%   z", " ".join(f"w{i}" for i in range(40)), "the same line of exactly eight words here\n" * 4 + "tail", "ab " * 30000]


def test_features_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(CASES)] + [(None, "null id"), (1, "again")], "doc_id long, text string"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    ratios = likelihood_ratios(docs, labels, buckets=512)
    assert any(ratios)
    rows = quality_rules(docs.withColumn("_body", F.lit(1)).withColumn("WINS", F.lit(2)), ratios, threshold=-0.1).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base, llr = brute(r.text, ratios)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert math.isclose(r.llr, llr, abs_tol=1e-9)
        assert r.kept == (not r.base_failed and r.llr >= -0.1)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    ratios = likelihood_ratios(docs, labels, buckets=16)
    assert ratios == [0.0] * 16
    assert quality_rules(docs, ratios).count() == 0


def test_junk_is_rejected_and_good_text_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules(docs, likelihood_ratios(docs, labels)).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"), F.avg((F.col("kept") | F.col("base_failed")).cast("int")).alias("v")).collect()
    kept = {r.quality: r for r in rows}
    assert kept[1].v > 0.99 and kept[0].k < 0.5
    assert kept[1].k == pytest.approx(kept[1].v, abs=0.2)


def _pair_hash(a, b):
    first, second = (xxhash.xxh64_intdigest(x.encode(), 42) for x in (a, b))
    return xxhash.xxh64_intdigest(second.to_bytes(8, "little"), xxhash.xxh64_intdigest(first.to_bytes(8, "little"), 42))


def test_pairs_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(CASES[:-1])] + [(100, "one two"), (None, "null id a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(5, 1), (7, 1), (7, 0), (9, 0)], "doc_id long, quality int")
    n, rows = 64, docs.collect()
    found = {k: ([0] * n, [0] * n) for k in (1, 2)}
    cells = {}
    for r in rows:
        w = [x for x in GAP.split(r.text or "") if x]
        cells[r.doc_id] = {1: [_pmod(xxhash.xxh64_intdigest(x.encode(), 42), n) for x in w], 2: [_pmod(_pair_hash(*p), n) for p in zip(w, w[1:], strict=False)]}
        for k, c in cells[r.doc_id].items():
            for x in c:
                found[k][0][x] += r.doc_id in (5, 7)
                found[k][1][x] += 1
    want = [math.log(t + 1) - math.log(a + 1) + math.log(sum(raw) + n) - math.log(sum(target) + n) for target, raw in found.values() for t, a in zip(target, raw, strict=True)]
    ratios = likelihood_ratios(docs, labels, buckets=n, order=2)
    assert ratios == pytest.approx(want)
    for r in quality_rules(docs, ratios, order=2).collect():
        each = [ratios[x] for x in cells[r.doc_id][1]] + [ratios[n + x] for x in cells[r.doc_id][2]]
        assert r.llr == pytest.approx(sum(each) / len(each) if each else 0.0, abs=1e-9)


def test_shuffled_words_are_rejected(spark):
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(300)]
    after = {w: rng.sample(vocabulary, 4) for w in vocabulary}

    def text():
        out = [rng.choice(vocabulary)]
        while len(out) < 150:
            out.append(rng.choice(after[out[-1]]))
        return out

    clean = [text() for _ in range(400)]
    salad = [rng.sample(t, len(t)) for t in clean]
    rows = [(i, " ".join(t)) for i, t in enumerate(clean + salad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules(docs, likelihood_ratios(docs, labels, buckets=1 << 12, order=ORDER), order=ORDER).collect()}
    assert all(got[i].kept for i in range(400)) and not any(got[i].kept for i in range(400, 800))
