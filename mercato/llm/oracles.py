"""SQL for chat formatting, centroid clustering and the manifest, with rounds and levels written out."""

from __future__ import annotations

from mercato.llm.centroid_clustering import K, MOST, ROUNDS, SCALE, SIZE
from mercato.llm.chat_formatting import BLOCK, MARKS
from mercato.llm.merkle_manifest import COLUMNS, FANOUT


def chats_sql() -> str:
    """Digests straight from the rows; lengths from the escaped texts and the marks."""

    def escaped(column: str) -> str:
        found = column
        for m in MARKS:
            rest = "".join(f"\\{c}" if c in "[]" else c for c in m[1:])
            first = f"\\{m[0]}" if m[0] == "[" else m[0]
            found = f"regexp_replace({found}, '{first}(\\\\*){rest}', '{m[0]}\\\\\\1{m[1:]}', 'g')"
        return found

    size = f"length({escaped('x')})"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role))),
n AS (SELECT *, CASE r WHEN 'user' THEN {size} + 13 WHEN 'system' THEN {size} + 15 WHEN 'assistant' THEN {size} + 4
  ELSE length({escaped('r')}) + {size} + 20 END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + 3 * count(DISTINCT floor(turn / {BLOCK})) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


def clusters_sql() -> str:
    """Every distance in every round."""
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(greatest(least(floor({SCALE} * CAST(x AS DOUBLE)), {MOST}), -{MOST}) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), p) - 1 AS INTEGER) AS c, p FROM v QUALIFY c < {K})"""]

    def assigned(r: int) -> str:
        return f"""SELECT vec_id, c, d, x FROM (SELECT v.vec_id, v.p AS x, k.c, list_sum(list_transform(list_zip(v.p, k.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d, v.rowid_
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM v) v, c{r} k) QUALIFY row_number() OVER (PARTITION BY rowid_ ORDER BY d, c) = 1"""

    for r in range(ROUNDS):
        steps.append(f"""a{r} AS MATERIALIZED ({assigned(r)}),
s{r} AS (SELECT c, i, sum(y) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS y, unnest(range({SIZE})) AS i FROM a{r}) GROUP BY c, i),
m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS p FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, CAST(coalesce(m.p, o.p) AS BIGINT[]) AS p FROM c{r} o LEFT JOIN m{r} m USING (c))""")
    return f"""WITH {', '.join(steps)}, f AS MATERIALIZED ({assigned(ROUNDS)})
SELECT vec_id, c AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.p, ',')) AS centroid_sha256
FROM f JOIN c{ROUNDS} k USING (c)
"""


def manifest_sql(levels: int = 6, tops: int = 3) -> str:
    """Trees of up to 16^levels rows a source and 16^tops sources, each row folded on its own."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    leaf = lambda *cols: f"sha256({' || '.join(map(field, cols))})"
    crc = """xor(list_reduce(list_transform(list_filter(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda s: s <> ''), lambda s: CAST(ascii(s) AS BIGINT)),
  lambda a, b: xor(list_reduce(range(8), lambda k, i: CASE WHEN k & 1 = 1 THEN xor(3988292384, k >> 1) ELSE k >> 1 END, xor(a, b) & 255), a >> 8), 4294967295), 4294967295)"""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    other = leaf(*COLUMNS[:-1], "lowered")
    steps = [f"""d AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END AS lowered FROM documents),
l AS (SELECT doc_id, {leaf(*COLUMNS)} AS node, {other} AS other, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM
  (SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM d)),
q AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, node) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM l),
n0 AS (SELECT t, i, n, node FROM q)"""]

    def level(k: int, down: str) -> str:
        return f"""p{k} AS MATERIALIZED (SELECT t, i // {FANOUT} AS i, n, list(node ORDER BY i) AS kids FROM {down} GROUP BY t, i // {FANOUT}, n),
n{k} AS (SELECT t, i, CAST(ceil(n / {FANOUT}) AS BIGINT) AS n, CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS node FROM p{k})"""

    steps += [level(k, f"n{k - 1}") for k in range(1, levels + 1)]
    steps.append(f"top AS (SELECT 0 AS t, t AS i, count(*) OVER () AS n, node FROM n{levels})")
    steps += [level(levels + k, f"n{levels + k - 1}" if k > 1 else "top") for k in range(1, tops + 1)]
    last = "SELECT doc_id, t, i, node AS leaf, other AS up, '' AS siblings FROM q"
    for k in range(1, levels + tops + 1):
        place, tree = ("w.i", "w.t") if k <= levels else ("w.t", "0")
        power = FANOUT ** ((k if k <= levels else k - levels) - 1)
        slot = f"({place} // {power}) % {FANOUT}"
        left, right = f"array_to_string(kids[1:{slot}], '')", f"array_to_string(kids[{slot} + 2:], '')"
        steps.append(f"""w{k} AS MATERIALIZED (SELECT w.* REPLACE (CASE WHEN n > 1 THEN sha256({left} || up || {right}) ELSE up END AS up,
  CASE WHEN n > 1 THEN siblings || {left} || {right} ELSE siblings END AS siblings) FROM ({last}) w JOIN p{k} p ON p.t = {tree} AND p.i = {place} // {power * FANOUT})""")
        last = f"SELECT * FROM w{k}"
    return f"""WITH {', '.join(steps)}
SELECT doc_id, leaf, s.node AS subroot, r.node AS root, sha256(siblings) AS proof_sha256, up AS folded_root, up = r.node AS verified
FROM ({last}) w JOIN n{levels} s ON s.t = w.t JOIN n{levels + tops} r ON true
"""
