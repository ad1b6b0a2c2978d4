"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed into cells (source, language, topic). Raking finds a factor for each source,
language and topic so that the weighted tokens meet all three target marginals. A document's
weight is the product of its factors. Probabilities are calibrated to a token budget, the share ``keep`` of
all tokens: weights are scaled up to it, cells that reach probability one are kept whole, and the others are
raked again under these caps. A category whose part of the budget exceeds its tokens is kept whole, and the
rest of the budget goes to the others in proportion to their targets; only there do expected tokens differ
from the targets. A document is kept if a number that its id alone determines lies below its probability.

Sources stay distributed however many there are: one row a source holds its cells, and each sweep is
one job that fits every source on its row and returns sums for (language, topic) pairs only. Languages
and topics are closed sets; more than ``MOST_PAIRS`` pairs raise an error rather than being cut.

Targets: shares by name, or an exponent, which takes the corpus's own shares to that power (1: as
they are, 0: equal). Defined cases: null source, language or topic is a category of its own, and so
are unknown names; categories without tokens keep factor 1; a category that the targets leave out
gets weight 0; a cell without tokens has weight 1 and probability ``keep`` (1 if no text has tokens); rows with the same id share one
draw; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import GAP_CHARS, private, words, written

MOST_PAIRS = 100_000
SWEEPS = 60
TOLERANCE = 1e-7
#: Exponents on the corpus's own shares.
TARGETS = {"source": 0.7, "lang": 0.7, "topic": 0.8}
DRAWS = 1 << 53
#: Expected tokens that are kept, as a share of all tokens.
KEEP = 0.5


def form_topic(text: Column, tokens: Column) -> Column:
    """A topic from the form of the whole text, for tables that have none."""
    t = F.coalesce(text, F.lit(""))
    solid = F.length(F.translate(t, GAP_CHARS, ""))
    share = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))) / solid
    return (
        F.when(solid == 0, "empty")
        .when(share("#*$%&|<>!") > 0.05, "marked")
        .when(share("0123456789") > 0.02, "figures")
        .when(tokens < 50, "note")
        .when(tokens >= 1000, "long")
        .otherwise("prose")
    )


def _targets(shares: dict, wanted: float | dict) -> dict:
    raw = {k: v**wanted if v else 0.0 for k, v in shares.items()} if isinstance(wanted, int | float) else {k: float(wanted.get(k, 0.0)) if v else 0.0 for k, v in shares.items()}
    total = sum(raw.values())
    return {k: v / total if total else 0.0 for k, v in raw.items()}


def _factors(own: dict, name: Column) -> Column:
    """The factor of a name, 1 for unknown ones."""
    given = [(k, v) for k, v in own.items() if k is not None]
    table = F.create_map(*[F.lit(x) for kv in given for x in kv]) if given else None
    return F.coalesce(F.when(name.isNull(), F.lit(own.get(None, 1.0))).otherwise(F.element_at(table, name) if given else F.lit(1.0)), F.lit(1.0))


def rake(cells: DataFrame, targets: dict[str, float | dict] = TARGETS, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells``: source, lang, topic, tokens (one row a cell, nulls allowed). Adds ``weight``."""
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    if not total:
        return cells.withColumn("weight", F.lit(1.0))
    share = F.col("tokens") / F.lit(float(total))
    pairs = cells.groupBy("lang", "topic").agg(F.sum(share).alias("w")).limit(MOST_PAIRS + 1).collect()
    if len(pairs) > MOST_PAIRS:
        raise ValueError(f"more than {MOST_PAIRS} pairs of language and topic")
    own = {"lang": {}, "topic": {}}
    for r in pairs:
        for k in own:
            own[k][r[k]] = own[k].get(r[k], 0.0) + r["w"]
    goal = {k: _targets(v, targets[k]) for k, v in own.items()}
    factor = {k: {x: 1.0 if g else 0.0 for x, g in goal[k].items()} for k in own}

    sources = cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens", share.alias("w"))).alias("held"), F.sum(share).alias("w"))
    if isinstance(targets["source"], int | float):
        wish = F.when(F.col("w") > 0, F.pow("w", F.lit(float(targets["source"])))).otherwise(0.0)
    else:
        named = [x for k, v in targets["source"].items() for x in (F.lit(k), F.lit(float(v)))]
        wish = F.when(F.col("w") > 0, F.coalesce(F.element_at(F.create_map(*named), F.col("source")), F.lit(0.0))).otherwise(0.0)
    sources = written(sources.withColumn("wish", wish), "sources")
    wishes = sources.agg(F.sum("wish").alias("n")).first()["n"]

    def factors(kind: str, name: Column) -> Column:
        return _factors(factor[kind], name)

    def fitted() -> DataFrame:
        """Sources with ``factor``, which meets their own marginal under the other factors."""
        now = F.aggregate("held", F.lit(0.0), lambda a, c: a + c["w"] * factors("lang", c["lang"]) * factors("topic", c["topic"]))
        return sources.withColumn("now", now).withColumn("factor", F.when(F.col("now") > 0, F.col("wish") / F.lit(wishes) / F.col("now")).otherwise(F.lit(0.0)))

    for _ in range(sweeps if wishes else 0):
        each = fitted().select("factor", F.explode("held").alias("c")).groupBy("c.lang", "c.topic").agg(F.sum(F.col("factor") * F.col("c.w")).alias("w"))
        base = {(r["lang"], r["topic"]): r["w"] for r in each.collect()}
        worst = 0.0
        for kind, at in (("lang", 0), ("topic", 1)):
            sums: dict = {}
            for p, w in base.items():
                sums[p[at]] = sums.get(p[at], 0.0) + w * factor["lang"][p[0]] * factor["topic"][p[1]]
            for x, g in goal[kind].items():
                if g and sums.get(x, 0.0) > 0:
                    worst = max(worst, abs(sums[x] / g - 1))
                    factor[kind][x] *= g / sums[x]
        if worst < tolerance:
            break
    out = fitted().select(F.col("source"), F.col("factor"), F.explode("held").alias("c"))
    weight = F.col("factor") * factors("lang", F.col("c.lang")) * factors("topic", F.col("c.topic"))
    out = out.select("source", "c.lang", "c.topic", F.when(F.col("c.w") > 0, weight).otherwise(1.0).alias("weight"), "c.tokens")
    return written(out, "weights")


def _filled(wish: dict, have: dict, budget: float) -> dict:
    """``budget`` dealt in proportion to ``wish``, to no one more than it has."""
    whole: set = set()
    while True:
        left = sum(v for k, v in wish.items() if k not in whole)
        scale = (budget - sum(have[k] for k in whole)) / left if left > 0 else 0.0
        more = {k for k in wish if k not in whole and wish[k] * scale > have[k]}
        if not more:
            return {k: float(have[k]) if k in whole else v * scale for k, v in wish.items()}
        whole |= more


def calibrate(weights: DataFrame, keep: float = KEEP, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``weights`` (see ``rake``) with ``probability``: expected tokens are ``keep`` of all, in the shares that the weights give.

    Each sweep is one job: the capped factor of a source is solved exactly on its row, and sums of capped and
    other tokens come back for (language, topic) pairs only.
    """
    if not 0 < keep <= 1:
        raise ValueError("keep must lie in (0, 1]")
    live = weights.filter((F.col("tokens") > 0) & (F.col("weight") > 0))
    total = weights.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    pairs = live.groupBy("lang", "topic").agg(F.sum("tokens").alias("have"), F.sum(F.col("tokens") * F.col("weight")).alias("wish")).collect()
    if not total or not pairs:
        return weights.withColumn("probability", F.when(F.lit(bool(total)) & (F.col("tokens") > 0), F.lit(0.0)).otherwise(F.lit(keep if total else 1.0)))
    budget = min(keep * total, float(sum(p["have"] for p in pairs)))
    goal, factor = {}, {}
    for kind in ("lang", "topic"):
        sums: dict = {}
        for p in pairs:
            have, wish = sums.get(p[kind], (0, 0.0))
            sums[p[kind]] = (have + p["have"], wish + p["wish"])
        goal[kind] = _filled({k: v[1] for k, v in sums.items()}, {k: v[0] for k, v in sums.items()}, budget)
        factor[kind] = dict.fromkeys(sums, 1.0)

    held = F.collect_list(F.struct("lang", "topic", "tokens", "weight")).alias("held")
    sources = live.groupBy("source").agg(held, F.sum("tokens").alias("have"), F.sum(F.col("tokens") * F.col("weight")).alias("wish"))
    sources = written(sources, "sources")
    scale = 0.0
    while True:  # sources that are kept whole only grow in number
        whole = F.col("wish") * F.lit(scale) > F.col("have")
        s = sources.agg(F.sum(F.when(whole, F.col("have")).otherwise(0)).alias("full"), F.sum(F.when(whole, 0.0).otherwise(F.col("wish"))).alias("wish")).first()
        grown = (budget - s["full"]) / s["wish"] if s["wish"] > 0 else scale
        if grown <= scale * (1 + 1e-12):
            break
        scale = grown
    sources = sources.withColumn("goal", F.least(F.col("wish") * F.lit(scale), F.col("have").cast("double")))

    def fitted() -> DataFrame:
        """One row a cell with ``x``: its weight under all factors, that of its source meeting the source's goal."""
        now = F.transform("held", lambda c: F.named_struct(F.lit("x"), c["weight"] * _factors(factor["lang"], c["lang"]) * _factors(factor["topic"], c["topic"]), F.lit("tokens"), c["tokens"], F.lit("lang"), c["lang"], F.lit("topic"), c["topic"]))
        each = sources.withColumn("now", F.sort_array(now, asc=False))  # the first cells reach the cap first

        def cap(a: Column, c: Column) -> Column:
            over = (a["left"] > 0) & (a["rest"] > 0) & (a["left"] * c["x"] > a["rest"])
            left, rest = a["left"] - c["tokens"], a["rest"] - c["tokens"] * c["x"]
            return F.named_struct(F.lit("left"), F.when(over, left).otherwise(a["left"]), F.lit("rest"), F.when(over, rest).otherwise(a["rest"]))

        rest = F.aggregate("now", F.lit(0.0), lambda a, c: a + c["tokens"] * c["x"])
        share = F.aggregate("now", F.named_struct(F.lit("left"), F.col("goal"), F.lit("rest"), rest), cap, lambda a: F.when((a["left"] > 0) & (a["rest"] > 0), a["left"] / a["rest"]))
        all_of_it = F.col("goal") >= F.col("have") * (1 - 1e-9)
        own = F.when(all_of_it, F.lit(1e200)).otherwise(F.coalesce(share, F.lit(1e200)))
        return each.select("source", own.alias("own"), F.explode("now").alias("c")).select("source", "c.lang", "c.topic", "c.tokens", (F.col("own") * F.col("c.x")).alias("x"))

    for _ in range(sweeps):
        capped, free = F.when(F.col("x") >= 1, F.col("tokens")).otherwise(0), F.when(F.col("x") >= 1, 0.0).otherwise(F.col("tokens") * F.col("x"))
        base = fitted().groupBy("lang", "topic").agg(F.sum(capped).alias("full"), F.sum(free).alias("free")).collect()
        worst, grown = 0.0, {}
        for kind in ("lang", "topic"):
            sums = {}
            for p in base:
                full, rest = sums.get(p[kind], (0, 0.0))
                sums[p[kind]] = (full + p["full"], rest + p["free"] * grown.get(p["lang"], 1.0))
            for k, (full, rest) in sums.items():
                want = goal[kind][k]
                worst = max(worst, abs((full + rest) / want - 1))
                step = (want - full) / rest if want > full and rest > 0 else want / (full + rest)
                step = min(max(step, 0.1), 10.0)
                factor[kind][k] = min(max(factor[kind][k] * step, 1e-60), 1e60)
                if kind == "lang":
                    grown[k] = step
        if worst < tolerance:
            break
    found = fitted().select("source", "lang", "topic", F.least(F.col("x"), F.lit(1.0)).alias("probability"))
    s, g, t = (weights[c].eqNullSafe(found[c]) for c in ("source", "lang", "topic"))
    out = weights.join(found, s & g & t, "left").select(weights["*"], found["probability"])
    unset = F.when(F.col("tokens") > 0, F.lit(0.0)).otherwise(F.lit(float(keep)))
    return written(out.withColumn("probability", F.coalesce("probability", unset)), "probabilities")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None, targets: dict[str, float | dict] = TARGETS, seed: int = 7, drop_text: bool = False, keep: float = KEEP) -> DataFrame:
    """``df`` with tokens, topic (if ``topic`` is None), weight, probability and kept added."""
    out = df.withColumn("tokens", F.size(words(F.col(text))).cast("long"))
    topic_name = topic or "topic"
    if topic is None:
        out = out.withColumn("topic", form_topic(F.col(text), F.col("tokens")))
    if drop_text:
        out = written(out.drop(text), "mixed")
    keys = [F.col(c).cast("string").alias(k) for c, k in ((source, "source"), (lang, "lang"), (topic_name, "topic"))]
    cells = written(out.select(*keys, "tokens").groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "cells")
    weights = calibrate(rake(cells, targets), keep)
    s, g, t = private(out, "_s", "_l", "_t")
    weights = weights.select(F.col("source").alias(s), F.col("lang").alias(g), F.col("topic").alias(t), "weight", "probability")
    same = F.col(source).cast("string").eqNullSafe(F.col(s)) & F.col(lang).cast("string").eqNullSafe(F.col(g)) & F.col(topic_name).cast("string").eqNullSafe(F.col(t))
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit(seed)), F.lit(DRAWS)) / F.lit(float(DRAWS))
    out = out.join(weights, same, "left").drop(s, g, t)
    return out.withColumn("kept", draw < F.col("probability"))
