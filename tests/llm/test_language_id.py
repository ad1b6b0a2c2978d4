"""Language identification: the vectors against their definition, held-out accuracy, defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from mercato.llm.language_id import Space, identify, learn
from mercato.llm.queries import op6_language_id


def test_bundle_follows_its_definition():
    s = Space(64)
    text = "Así es, así: 9 así"
    letters = "\0así\0es\0así\0así\0"
    vector = {c: s._letter(ord(c)).astype(int) for c in set(letters)}
    want = sum(np.roll(vector[a], 2) * np.roll(vector[b], 1) * vector[c] for a, b, c in zip(letters, letters[1:], letters[2:], strict=False))
    assert (s.bundle(text) == want).all()
    assert s.bundle("12 34!") is None and s.bundle("") is None and s.bundle(None) is None
    assert s.bundle("x") is not None


def test_held_out_accuracy(spark):
    here = "/root/testdata/sf0.1"
    rows = op6_language_id(spark, here).join(spark.read.parquet(f"{here}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 10000
    for r in rows:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98


def test_defined_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("score", F.lit("own"))
    model = learn(docs)
    assert sorted(model) == list(model)
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "12 !"), (2, "de la " * 40000), (2, "de la " * 40000)], "doc_id long, text string")
    rows = identify(odd, model).collect()
    assert [(r.lang_pred, r.score) for r in rows[:3]] == [("und", 0.0)] * 3
    assert rows[3] == rows[4] and rows[3].lang_pred in model
    assert identify(odd.limit(0), model).count() == 0
    assert learn(docs.limit(0)) == {}
    assert {r.lang_pred for r in identify(odd, {}).collect()} == {"und"}
