"""The pipeline's stages: what each drops, keeps and changes, on their own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from mercato.llm.common import written
from mercato.llm.jaccard_join import jaccard_groups
from tests.llm.test_packing import PATH, check, expected
from tests.llm.test_secret_scan import brute as secrets_of

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        got = written(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, got))
        docs = got
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "jaccard_join", "secret_scan", "mixing", "packing"]
    for _, got in stages[:-1]:
        assert got.columns == COLUMNS


def test_quality_keeps_good_documents(spark, stages):
    before, after = rows(stages[0][0]), rows(stages[0][1])
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    long = [i for i in good if len(before[i].text.split()) >= 20]
    assert after.items() <= before.items() and len(after) < len(before)
    assert sum(i in after for i in long) / len(long) > 0.97


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1]
    group = {r.doc_id: r.component_id for r in jaccard_groups(before).collect()}
    assert set(rows(after)) == set(group.values()) and len(set(group.values())) < len(group)


def test_secrets_are_masked_and_nothing_else_changes(stages):
    before, after = rows(stages[2][0]), rows(stages[2][1])
    assert before.keys() == after.keys()
    hit = 0
    for i, r in before.items():
        spans = secrets_of(r.text)[1]
        hit += bool(spans)
        assert (after[i].text == r.text) == (not spans)
        assert after[i].n_chars == len(after[i].text) and not any(secrets_of(after[i].text)[0].count(k) for k in ("assign", "access", "hex"))
    assert hit


def test_mixture_is_a_draw_and_packing_is_whole(stages):
    before, after = rows(stages[3][0]), rows(stages[3][1])
    assert 0 < len(after) < len(before) and after.items() <= before.items()
    docs = list(after.values())
    assert check(stages[4][1].collect(), list(zip([d.doc_id for d in docs], expected([d.text for d in docs]), strict=True))) < 0.02
    assert PATH


@pytest.mark.parametrize("k", range(5))
def test_odd_rows_and_empty_table(spark, k):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "word " * 60, "en", None, 300), (2, "", "en", "s", 0), (3, "a b c " * 9000, "en", "s", 54000), (4, 'token = "abcdefgh1"', None, "s", 19), (5, "x", "en", "s", 1), (5, "x", "en", "s", 1)]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").withColumn("Kept", F.lit("mine")).withColumn("tokens", F.col("doc_id"))
    stage = P.STAGES[k][1]
    got = stage(spark, df, SF)
    kept = sorted((r.doc_id for r in got.collect()), key=lambda i: (i is not None, i))
    every = [None, 1, 2, 2, 3, 4, 5, 5]
    if k == 4:  # every token of every row is packed
        check(got.collect(), [(r[0], ids) for r, ids in zip(odd, expected([r[1] for r in odd]), strict=True)])
    else:  # rules: short texts and those of one word go; copies: of two equal rows one stays, empty ones all; masks: every row; the draw: some
        assert kept == {0: [], 1: [None, 1, 2, 2, 3, 4, 5], 2: every}.get(k, kept) and not set(kept) - set(every)
    if k < 4:
        assert got.columns == df.columns
        assert all(r.Kept == "mine" and r.tokens == r.doc_id for r in got.collect())
    assert stage(spark, df.limit(0), SF).count() == 0


def test_near_copies_tells_rows_apart(spark):
    text = " ".join(f"w{i}" for i in range(80))
    other, third = text.replace("w1", "v1"), " ".join(f"z{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, third), (None, third), (5, other), (6, other + " end"), (5, "a clean text of its own under the id of a copy"),
            (7, ""), (7, ""), (8, None), (9, text + " x"), (None, text)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.near_copies(spark, df.repartition(3), SF).collect()), key=str)
    assert got == sorted([(1, text), (None, third), (5, other), (5, rows[6][1]), (7, ""), (7, ""), (8, None)], key=str)
