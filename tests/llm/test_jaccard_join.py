"""Jaccard groups against all pairs on small tables."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from mercato.llm.jaccard_join import components, jaccard_groups
from mercato.llm.queries import llm_oracles, op7_jaccard_join


def brute(rows, size, percent):
    sets = []
    for i, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")) if x]
        sets.append((i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
    top = list(range(len(sets)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                top[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def got(df, **how):
    return sorted((tuple(r) for r in jaccard_groups(df, **how).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def made(seed, count=140):
    """Families of near copies around the threshold, with shared passages, copies and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    rows = []
    while len(rows) < count:
        base = rng.choices(words, k=rng.choice([3, 8, 40, 120, 200]))
        for _ in range(rng.choice([1, 1, 2, 8, 20])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w) + (" " + passage if rng.random() < 0.3 else "")
            rows.append((len(rows), text.upper() if rng.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_groups_match_all_pairs(spark, seed, size, percent):
    rows = made(seed) + [(1000, None), (1001, ""), (1002, " \t"), (1003, "One"), (1004, "one"), (1004, "one"), (None, "one two"), (None, None), (1005, "x " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("other")).withColumn("n", F.lit(1))
    assert got(df.repartition(5), size=size, percent=percent) == brute(rows, size, percent)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = sorted(con.sql(llm_oracles()["op7_jaccard_join"]).fetchall())
    rows = sorted(tuple(r) for r in op7_jaccard_join(spark, "/root/testdata/sf0.01").collect())
    assert rows == want
    assert any(i != c for i, _, c in rows)


def test_components_of_a_shuffled_path_take_few_rounds(spark, monkeypatch):
    import mercato.llm.jaccard_join as J

    rounds = []
    monkeypatch.setattr(J, "written", lambda df, name, to=J.written: (rounds.append(name), to(df, name))[1])
    ids = list(range(600))
    random.Random(5).shuffle(ids)
    edges = spark.createDataFrame([(min(p), max(p)) for p in zip(ids, ids[1:], strict=False)], "a long, b long")
    assert {r.component for r in components(edges).collect()} == {0}
    assert rounds.count("labels") <= 14


def test_long_chain_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 600), (550, 600)], "a long, b long")
    want = {i: 0 for i in range(301)} | {500: 500, 550: 500, 600: 500}
    assert {r.node: r.component for r in components(edges).collect()} == want
    assert jaccard_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
