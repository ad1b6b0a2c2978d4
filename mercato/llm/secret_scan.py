"""Secrets in texts: three sure patterns, and weak parts of multipart credentials linked by scope.

Sure spans (``assign``, ``access``, ``hex``) count on their own. Weak parts say little alone: short
access keys or named identifiers (``id``), short hex runs or other named values (``key``), and hosts,
URLs, regions or buckets (``endpoint``). They are joined by interval with the parts around them: a
weak identifier is reported if a secret starts within ``SCOPE`` code points of it in the same text,
a weak secret if an identifier does, an endpoint if both do. Sure spans take part in the join.

The join is by (text, block of SCOPE code points): each weak part looks into its own and the two
neighbouring blocks, where every role is pre-aggregated to its first and last start, so it meets at
most three rows a role, however many parts a block holds. Equal texts share one set of parts.

Defined cases: null and empty texts have no spans; repeated rows each get the same result; other
columns are carried along and may have any name but those of the added columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import private, written

# The sure patterns and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

# Weak parts: an AKIA run of 12 to 19 characters, a hex run of 16 to 23, or one of these.
WEAK_ACCESS_LENGTH = 12
WEAK = (
    r"""(?i)(?:(access[_-]?key(?:[_-]?id)?|client[_-]?id|account(?:[_-]?id)?|user(?:[_-]?name)?|login)"""
    r"""|(pwd|passphrase|private[_-]?key|secret[_-](?:access[_-])?key|credentials?)"""
    r"""|(endpoint|host(?:[_-]?name)?|server|region|bucket|url))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.:@=-]{4,}"""
    r"""|https?://[^\x20\x09-\x0D"'<>]+"""
)
SCOPE = 256
#: Code points of a block in which a redaction looks up its gaps.
BLOCK = 1024
#: Kinds in order, and the role each plays in a credential.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "id": "id", "key": "secret", "endpoint": "endpoint"}
SURE = 3

_SPAN = "array<struct<start:int,kind:int,upto:int>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside another lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(values: Column, fold) -> Column:
    """For every place of an array of non-negative ints, ``fold`` (an associative one, 0 at the start) of those before it.

    Runs of about the cube root of n values are folded first, then the runs before a run, so the
    whole takes n ** (4/3) steps and appends to no array.
    """
    each = lambda part: F.aggregate(part, F.lit(0), fold)

    def folded(v):
        width = F.ceil(F.cbrt(F.size(v))).cast("int")
        runs = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / width).cast("int"))
        sums = lambda w: F.transform(runs, lambda r: each(F.slice(v, r * w + 1, w)))
        tops = lambda t: F.transform(t, lambda _, k: each(F.slice(t, F.lit(1), k)))
        place = lambda w, top: F.transform(v, lambda _, k: fold(F.get(top, F.floor(k / w).cast("int")), each(F.slice(v, k - k % w + 1, k % w))))
        return F.when(F.size(v) > 0, _bound(width, lambda w: _bound(_bound(sums(w), tops), lambda top: place(w, top)))).otherwise(v)

    return _bound(values, folded)


def _later(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _matches(text: Column, pattern: str, groups: int = 0) -> Column:
    """start, upto (code points) and the captured groups of all leftmost non-overlapping matches.

    The gaps between matches (a split) and the matches alternate, so running lengths give places.
    """
    p = F.lit(pattern)
    found = [F.regexp_extract_all(text, p, F.lit(g)) for g in range(groups + 1)]
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found[0]))
    pieces = F.arrays_zip(gaps.alias("gap"), *[f.alias(f"g{k}") for k, f in enumerate(found)])
    shape = "".join(f",g{k}:string" for k in range(1, groups + 1))

    def place(m, at):
        start = at + F.length(m["gap"])
        return F.struct(start.alias("start"), (start + F.length(m["g0"])).alias("upto"), *[m[f"g{k}"].alias(f"g{k}") for k in range(1, groups + 1)])

    def placed(ms):
        lengths = F.transform(ms, lambda m: F.length(m["gap"]) + F.length(m["g0"]))
        return _bound(_before(lengths, lambda a, n: a + n), lambda at: F.transform(ms, lambda m, k: place(m, F.get(at, k))))

    return F.when(F.regexp_like(text, p), _bound(pieces, placed)).otherwise(F.array().cast(f"array<struct<start:int,upto:int{shape}>>"))


def _apart(weak: Column, sure: Column) -> Column:
    """The spans of ``weak`` that overlap none of ``sure``.

    Sure spans stand at their starts and weak ones at their ends, weak first at one place: a weak
    span is free if no sure one before it reaches beyond its start.
    """
    stand = lambda at, what, reach, s: F.struct(at.alias("at"), F.lit(what).alias("what"), reach.alias("reach"), s.alias("span"))
    events = F.array_sort(F.concat(F.transform(sure, lambda s: stand(s["start"], 1, s["upto"], s)), F.transform(weak, lambda s: stand(s["upto"], 0, F.lit(0), s))))

    def free(es):
        reach = _before(F.transform(es, lambda e: e["reach"]), _later)
        return _bound(reach, lambda r: F.filter(es, lambda e, k: (e["what"] == 0) & (F.get(r, k) <= e["span"]["start"])))

    return F.transform(_bound(events, free), lambda e: e["span"])


def _spans(matches: Column, keep, kind) -> Column:
    """Those of ``matches`` that ``keep`` holds for, as spans of kind number ``kind(match)``."""
    return F.transform(F.filter(matches, keep), lambda m: F.struct(m["start"].alias("start"), kind(m).cast("int").alias("kind"), m["upto"].alias("upto")))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["upto"])), ",")


def secret_scan(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``df`` with n_assign, n_access, n_hex, base_spans and spans (arrays of start, kind, upto) added.

    The patterns run once; their spans are written to the shared folder before the join. Texts that stay
    are not written with them: ``df`` is read a second time and meets its spans by the hash of its text,
    so a text is dealt out once, whatever share of the texts holds secrets. ``df`` must give the same
    texts both times.
    """
    body, ma, mk, mh, mw, sure, weak, key = private(df, "_body", "_ma", "_mk", "_mh", "_mw", "_sure", "_weak", "_key")
    t = F.col(body)
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    out = df.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    out = out.withColumns({ma: _matches(t, ASSIGN, 2), mk: _matches(t, ACCESS), mh: _matches(t, HEX), mw: _matches(t, WEAK, 3), key: digest(t)})
    long_as = lambda least: lambda m: m["upto"] - m["start"] >= least
    short = lambda low, high: lambda m: (m["upto"] - m["start"] >= low) & (m["upto"] - m["start"] < high)
    certain = F.array_sort(
        F.concat(
            _spans(F.col(ma), lambda m: F.length(m["g2"]) >= ASSIGN_VALUE, lambda m: F.lit(0)),
            _spans(F.col(mk), long_as(ACCESS_LENGTH), lambda m: F.lit(1)),
            _spans(F.col(mh), long_as(HEX_LENGTH), lambda m: F.lit(2)),
        )
    )
    named = lambda m: F.when(m["g1"] != "", 3).when(m["g2"] != "", 4).otherwise(5)
    maybe = F.concat(
        _spans(F.col(mk), short(WEAK_ACCESS_LENGTH, ACCESS_LENGTH), lambda m: F.lit(3)),
        _spans(F.col(mh), short(0, HEX_LENGTH), lambda m: F.lit(4)),
        _spans(F.col(mw), lambda m: m["upto"] > m["start"], named),
    )
    out = out.withColumns({sure: certain, weak: maybe})
    out = out.drop(body, ma, mk, mh, mw, text) if drop_text else out.select(key, sure, weak)
    out = written(out.withColumn(weak, F.when((F.size(weak) > 0) & (F.size(sure) > 0), _apart(F.col(weak), F.col(sure))).otherwise(F.col(weak))), "secrets")

    added, same = private(df, "_added", "_same")
    linked = _linked(out.select(F.col(key).alias("key"), F.col(sure).alias("sure"), F.col(weak).alias("weak")))
    linked = linked.select(F.col("key").alias(same), F.col("spans").alias(added))
    if not drop_text:  # one row a text
        out = out.groupBy(key).agg(F.first(sure).alias(sure))
    out = out.join(linked, F.col(key) == F.col(same), "left").drop(weak, same)
    if not drop_text:
        out = out.withColumnRenamed(key, same)
        out = df.withColumn(key, digest(F.coalesce(F.col(text), F.lit("")))).join(out, F.col(key) == F.col(same), "left")
    every = F.when(F.col(added).isNull(), F.col(sure)).otherwise(F.array_sort(F.concat(sure, added)))
    count = lambda k: F.size(F.filter(sure, lambda s: s["kind"] == k)).cast("long")
    out = out.withColumns({"base_spans": F.col(sure), "spans": every, "n_assign": count(0), "n_access": count(1), "n_hex": count(2)})
    return out.drop(sure, key, added, same)


def _linked(texts: DataFrame) -> DataFrame:
    """Weak spans (key, spans) that complementary parts make credible. ``texts``: key, sure, weak."""
    role = F.array(*[F.lit(ROLE[k]) for k in KINDS])
    roles = F.array_distinct(F.transform(F.concat("sure", "weak"), lambda s: F.get(role, s["kind"])))
    whole = (F.size("weak") > 0) & F.array_contains(roles, "id") & F.array_contains(roles, "secret")
    parts = texts.filter(whole).select("key", F.explode(F.concat("sure", "weak")).alias("s")).select("key", "s.*").distinct()
    parts = parts.withColumns({"role": F.get(role, F.col("kind")), "block": F.floor(F.col("start") / SCOPE)})
    scopes = parts.groupBy("key", "block", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    scopes = scopes.withColumnRenamed("role", "other")
    weak = parts.filter(F.col("kind") >= SURE).withColumn("block", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.col("block") + d)))
    near = weak.join(scopes, ["key", "block"]).filter((F.col("last") >= F.col("start") - SCOPE) & (F.col("first") <= F.col("start") + SCOPE))
    met = near.groupBy("key", "start", "kind", "upto", "role").agg(F.bool_or(F.col("other") == "id").alias("id"), F.bool_or(F.col("other") == "secret").alias("secret"))
    credible = F.when(F.col("role") == "id", F.col("secret")).when(F.col("role") == "secret", F.col("id")).otherwise(F.col("id") & F.col("secret"))
    return met.filter(credible).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "upto")).cast(_SPAN).alias("spans"))


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mask: str = "<SECRET>") -> DataFrame:
    """``df`` with every maximal covered run of ``text`` replaced by ``mask``; null text stays null.

    ``spans`` ascend by start. The text is cut into blocks of ``BLOCK`` code points once, so a gap costs
    its own length and no walk from the start of the text.
    """
    t = F.col(text)

    def piece(blocks, low, high):
        first = F.floor(low / BLOCK).cast("int")
        some = F.slice(blocks, first + 1, F.floor((high - 1) / BLOCK).cast("int") - first + 1)
        return F.when(high > low, F.substring(F.array_join(some, ""), low - first * BLOCK + 1, high - low)).otherwise(F.lit(""))

    def lead(blocks, reach, s, k):
        done = F.get(reach, k)  # how far the spans before this one reach
        masked = F.concat(piece(blocks, done, s["start"]), F.when((k == 0) | (s["start"] > done), F.lit(mask)).otherwise(F.lit("")))
        return F.when(s["upto"] > done, masked).otherwise(F.lit(""))

    def masked(blocks, of):
        reach = _before(F.transform(of, lambda s: s["upto"]), _later)
        leads = _bound(reach, lambda r: F.array_join(F.transform(of, lambda s, k: lead(blocks, r, s, k)), ""))
        last = F.array_max(F.transform(of, lambda s: s["upto"]))
        return F.concat(leads, piece(blocks, last, F.length(t)))

    blocks = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    whole = _bound(F.col(spans), lambda of: _bound(blocks, lambda b: masked(b, of)))
    return df.withColumn(text, F.when(t.isNotNull() & (F.size(spans) > 0), whole).otherwise(t))
