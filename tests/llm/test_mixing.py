"""Mixing: factors against a plain raking loop, and the sampled shares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm.mixing import TARGETS, calibrate, mix, rake
from mercato.llm.queries import op10_mixing


def brute(cells, targets, sweeps=400):
    total = sum(c[3] for c in cells)
    w = np.array([c[3] / total for c in cells])
    out = w.copy()
    for _ in range(sweeps):
        for k, name in enumerate(("source", "lang", "topic")):
            share = {}
            for c, x in zip(cells, w, strict=True):
                share[c[k]] = share.get(c[k], 0) + x
            t = targets[name]
            goal = {v: (s**t if s else 0) if isinstance(t, float) else t.get(v, 0) for v, s in share.items()}
            size = sum(goal.values())
            now = {}
            for c, x in zip(cells, out, strict=True):
                now[c[k]] = now.get(c[k], 0) + x
            out = np.array([x * goal[c[k]] / size / now[c[k]] if now[c[k]] else 0 for c, x in zip(cells, out, strict=True)])
    return {c[:3]: o / x if x else 1.0 for c, o, x in zip(cells, out, w, strict=True)}


@pytest.mark.parametrize("targets", [TARGETS, {"source": {"a": 0.5, "b": 0.5}, "lang": 0.0, "topic": 1.0}])
def test_weights_match_plain_raking(spark, targets):
    rng = np.random.default_rng(3)
    cells = [(s, g, t, int(rng.integers(1, 1000))) for s in ("a", "b", "c", None) for g in ("x", "y", None) for t in ("p", "q")]
    targets = {k: v if isinstance(v, dict) else float(v) for k, v in targets.items()}
    want = brute(cells, targets)
    got = {(r.source, r.lang, r.topic): r.weight for r in rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), targets).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-4, abs=1e-9)


def test_query_meets_marginals(spark):
    rows = op10_mixing(spark, "/root/testdata/sf0.01").toPandas()
    assert len(rows) == 1000
    assert rows.probability.between(0, 1).all() and rows.probability.max() == pytest.approx(1)
    total = rows.tokens.sum()
    for k in ("source", "lang", "topic"):
        own = rows.groupby(k).tokens.sum() / total
        goal = own ** TARGETS[k] / (own ** TARGETS[k]).sum()
        now = (rows.tokens * rows.weight).groupby(rows[k]).sum() / total
        assert np.allclose(now, goal, rtol=1e-3)
    assert (rows.kept.mean() - rows.probability.mean()) == pytest.approx(0, abs=0.05)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "a b", None, "en", 9), (1, "a b", None, "en", 9), (None, None, "s", None, 1), (3, "", "s", "en", 1), (4, "x " * 5000, "s", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, _s int").withColumn("factor", F.lit(1))
    got = mix(df).collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got)
    assert len({r.kept for r in got if r.doc_id == 1}) == 1
    assert mix(df.limit(0)).count() == 0
    assert [r.kept for r in mix(df.filter("doc_id = 3")).collect()] == [True]  # no tokens at all: weight 1


def test_a_rare_source_does_not_shrink_the_draw(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "w " * int(rng.integers(30, 90)), "hot" if i % 3 == 0 else f"s{i % 10}", ("en", "de")[i % 7 == 0], ("p", "q", None)[i % 11 % 3]) for i in range(3000)]
    rows.append((3000, "w " * 34, "rare", "en", "p"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    got = mix(docs, topic="topic").toPandas()
    assert (got.tokens * got.probability).sum() / got.tokens.sum() == pytest.approx(0.5, rel=1e-6)
    assert got[got.source == "rare"].probability.item() == 1
    assert got[got.kept].tokens.sum() / got.tokens.sum() == pytest.approx(0.5, abs=0.05)
    for k in ("source", "lang", "topic"):
        name = got[k].fillna("none")
        goal = (got.tokens * got.weight).groupby(name).sum() / got.tokens.sum()
        drawn = (got.tokens * got.probability).groupby(name).sum()
        assert np.allclose((drawn / drawn.sum()).drop("rare", errors="ignore"), goal.drop("rare", errors="ignore"), rtol=0.01)


def test_budget_is_met_under_caps(spark):
    cells = [("a", "x", "p", 900), ("a", "y", "p", 50), ("b", "x", "q", 30), ("b", "y", "p", 10), ("c", "x", "p", 5), (None, None, "q", 5)]
    weights = rake(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), {"source": 0.0, "lang": 0.5, "topic": 0.5})
    for keep in (0.05, 0.5, 0.9, 1.0):
        rows = calibrate(weights, keep).collect()
        assert all(0 <= r.probability <= 1 for r in rows) and len(rows) == 6
        assert sum(r.tokens * r.probability for r in rows) == pytest.approx(keep * 1000, rel=1e-6)
