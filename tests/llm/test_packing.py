"""Packing: every id once, in order, within sequences of bounded padding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercato.llm.packing import OPEN, SEQUENCE, pack
from mercato.llm.queries import op1_packing, public_tokenizer

PATH = public_tokenizer("word_bpe_49k.json")
TEXTS = [None, "", "a", "<|endoftext|> <|EndOfText|> A.B,c", "É É’s it's DON'T ...,, x.", "a\x1cb c d\x85e", "word " * 20000, "日本語 text, 1234.", "İstanbul ΣΑΣ ß", "..", "a," * 10]


def expected(rows):
    t = Tokenizer.from_file(PATH)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for x in rows]


def check(pieces, docs, sequence=SEQUENCE):
    """docs: list of (doc_id, ids); pieces of equal doc ids are compared as a multiset."""
    want, have = defaultdict(int), defaultdict(int)
    for i, ids in docs:
        want[i] += len(ids)
    by_id = {i: ids for i, ids in docs}
    sequences = defaultdict(list)
    for p in pieces:
        ids = by_id[p.doc_id][p.start : p.start + p.length]
        assert p.length > 0 and len(ids) == p.length and p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(by_id[p.doc_id])
        have[p.doc_id] += p.length
        sequences[p.sequence_id].append((p.offset, p.length))
    assert have == want
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= sequence
        padding += 0 if at & (at - 1) == 0 else sequence - at
    return padding / max(1, sum(want.values()))


def test_query_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    pieces = op1_packing(spark, "/root/testdata/sf0.01").collect()
    assert check(pieces, list(zip([d.doc_id for d in docs], expected([d.text for d in docs]), strict=True))) < 0.006
    starts = defaultdict(list)
    for p in pieces:
        starts[p.doc_id].append((p.start, p.length))
    assert all(sum(n for s, n in v if s < x[0]) == x[0] for v in starts.values() for x in v)


def test_odd_texts_many_tasks_and_rounds(spark):
    rows = [(None if i == 3 else i, t) for i, t in enumerate(TEXTS * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(70).withColumn("START", F.lit(1))
    pieces = pack(df, PATH, sequence=64).collect()
    check(pieces, list(zip([r[0] for r in rows], expected([r[1] for r in rows]), strict=True)), 64)


def test_one_long_document_and_empty_table(spark):
    pieces = pack(spark.createDataFrame([(1, "a b " * 10000)], "doc_id long, text string"), PATH).collect()
    assert check(pieces, [(1, expected(["a b " * 10000])[0])]) == 0
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    assert OPEN > 1 and pytest.approx(SEQUENCE) == 4096
