"""Compression classifier: held-out accuracy and defined cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from mercato.llm.quality_classifier import classify, fit
from mercato.llm.queries import op2_quality_classifier

HERE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = op2_quality_classifier(spark, HERE).join(spark.read.parquet(f"{HERE}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.97
    bad = [r for r in out if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.85
    good = sorted(r.score for r in out if r.quality == 1)
    assert sum(g > b.score for b in bad for g in good) / len(bad) / len(good) > 0.97


def test_defined_cases(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    odd = spark.createDataFrame([(1, None, 3.0), (1, "", 3.0), (None, "word " * 50000, None), (2, "a", 0.0), (2, "a", 0.0)], "doc_id long, text string, score double")
    rows = classify(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text in (None, "")}) == 1
    assert classify(odd.limit(0), model).count() == 0


def test_one_class_only_gives_the_prior(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    scores = {r.score for r in classify(docs, fit(docs, labels)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9
    none = fit(docs, labels.limit(0))
    assert {r.score for r in classify(docs, none).collect()} == {0.5}
    assert fit(docs.limit(0), labels.limit(0))["prior"] == pytest.approx(0.5)
