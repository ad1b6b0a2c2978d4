"""Exact n-gram Jaccard join of documents, answered as linked groups.

A document's set holds the hashes of its distinct word shingles. Sets are ordered by one global order,
rare shingles first, and two sets that link must share a shingle within their prefixes (the first
``n - ceil(t n) + 1``). The order comes from a count sketch of fixed size over all documents, so it
costs no shuffle of shingles; any order is correct, a good one keeps lists of common passages out.

Set relations save the rest of the work:

* Equal sets are one node. Only nodes have postings, and postings that no second node shares never travel
  as rows: chunks of nodes ask shards which of their tokens two nodes hold.
* Index lists are sorted by size and position. Each set is first verified against the neighbour it has in
  most of its lists, which ties copies into components by one pair a set.
* A set takes over the answers of a set it is linked with: what is in one component needs no further
  pair. Lists are read again for pairs across components only; within a list, sets are skipped by size
  and from the position on at which the overlap can no longer suffice.
* Before whole sets meet, their parity bitmaps do: differing bits bound the differing shingles from below.
* Of all pairs that could join two components a forest is verified first: the most alike, none between
  components that it has joined already. Members of one group thus cost pairs in the number of their
  components, not of its square. Then every pair is verified that is still between components, so no link
  is lost. Where a task finds more than ``FEW`` pairs a set, it gives the forest only, and its lists are
  read again once those links are merged.

Lists that share their smallest component are read by one task, which gets each set's bitmap once. What is
more than ``GROUP_ROWS`` rows is dealt to several by token, and a longer list in pairs of blocks of sets.

Defined cases: documents without words (or text) have an empty set and stand alone; fewer words than a
shingle make one shingle; rows with equal ids and texts fall together; a group whose ids are all null
has a null component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import text_batches, written
from mercato.llm.shared_hashes import ASKED, SAID, answer, answers, arrow_table, ask, codes, ddl

SHINGLE, PERCENT = 5, 80
#: The sketch: rows, cells of a row, and the slices that travel.
SKETCH_ROWS, SKETCH_CELLS, SLICES = 2, 1 << 18, 64
#: Words whose hashes a worker keeps, some 150 bytes each.
REMEMBERED = 250_000
BATCH_BYTES = 4 << 20
#: Nodes are dealt into chunks of about so many prefix tokens.
CHUNK_TOKENS = 1 << 19
#: Rows of lists that a task reads at once.
GROUP_ROWS = 1 << 16
#: Pairs that a task holds before it drops repeated and impossible ones.
HELD_PAIRS = 1 << 21
#: A forest takes pairs that seem to differ by up to so much of what a link may.
SEEMS = 1.1
#: A task that finds more than so many pairs a set reads its lists again after a forest of them.
FEW = 4
#: Lists of up to so many sets are compared all at once.
SHORT_LIST = 32
#: The filter for members whose whole sets are wanted: bits a member, bits at least and at most (64 MB), and its slices.
FILTER_SHARE, FILTER_LEAST, FILTER_MOST, FILTER_SLICES = 16, 1 << 20, 1 << 29, 64

_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


_known = _WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, size: int) -> np.ndarray:
    """64-bit hashes of the shingles of a text, in order; A-Z count as a-z."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    out = h[:n].copy()
    for k in range(1, width):
        out = out * _STEP + h[k : k + n]
    return mixed(out + np.uint64(width))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    return np.unique(shingles(text, size))


def _sets(batches: Iterator[pa.RecordBatch], size: int, made=shingle_set) -> Iterator[tuple]:
    for batch in text_batches(batches, 1, BATCH_BYTES):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield doc_id, made(text.encode() if text else b"", size)


def _cells(hashes: np.ndarray, row: int) -> np.ndarray:
    return ((hashes >> np.uint64(20 * row)) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How often the shingles of a cell occur, repeats counted: an array of fixed size, summed over all documents."""
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def count(batches):
        total, held, n = np.zeros((SKETCH_ROWS, SKETCH_CELLS), np.uint32), [], 0

        def flush():
            every = np.concatenate(held)
            for r in range(SKETCH_ROWS):
                total[r] += np.bincount(_cells(every, r), minlength=SKETCH_CELLS).astype(np.uint32)

        for _, hashes in _sets(batches, size, shingles):
            held.append(hashes)
            n += len(hashes)
            if n > 1 << 20:
                flush()
                held, n = [], 0
        if held:
            flush()
            parts = total.reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH_ROWS * SKETCH_CELLS // SLICES, np.uint32)
        for b in pdf["counts"]:
            total += np.frombuffer(b, np.uint32)
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "counts": [total.tobytes()]})

    parts = docs.mapInArrow(count, "slice int, counts binary")
    parts = parts.groupBy("slice", F.pmod(F.xxhash64("counts"), F.lit(16))).applyInPandas(add, "slice int, counts binary")
    out = np.zeros((SLICES, SKETCH_ROWS * SKETCH_CELLS // SLICES), np.uint32)
    for r in parts.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect():
        out[r["slice"]] = np.frombuffer(r["counts"], np.uint32)
    return out.reshape(SKETCH_ROWS, SKETCH_CELLS)


_ROW = "doc_id long, n long, node long, prefix array<long>, parity array<long>"


def parity(hashes: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the hashes fall on, two places a hash or more, as 64-bit words."""
    words = 1 << max(0, int(len(hashes) - 1) >> 5).bit_length()
    at = (mixed(hashes + _STEP) % np.uint64(64 * words)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _nodes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n, node (hash of the whole set; null if empty), prefix and parity, for every document.

    A task gives prefix and parity once a node, so copies are combined before anything is shuffled.
    """
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(docs, size))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(("doc_id", "n", "node", "prefix", "parity"), kinds, strict=True)))

    def run(batches):
        counts, rows, held, given = sketch.value, [], 0, set()

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for doc_id, hashes in _sets(batches, size):
            n = len(hashes)
            node = _node(hashes) if n else None
            if not n or node in given:
                rows.append((doc_id, n, node, None, None))
            else:
                given.add(node)
                often = np.minimum.reduce([counts[r][_cells(hashes, r)] for r in range(SKETCH_ROWS)])
                order = np.argsort(np.log2(often + 1).astype(np.uint8), kind="stable")
                prefix = hashes[order[: n - -(-percent * n // 100) + 1]].view(np.int64)
                rows.append((doc_id, n, node, prefix, parity(hashes)))
                held += len(prefix)
            if held > 1 << 18 or len(rows) > 10_000:
                yield batch_of()
                rows, held = [], 0
        if rows:
            yield batch_of()

    return written(docs.mapInArrow(run, _ROW), "sets")


class _Chunk:
    """Distinct nodes of a chunk and their prefix tokens."""

    def __init__(self, table: pa.Table):
        nodes, first = np.unique(np.asarray(table["node"]), return_index=True)
        prefixes = table["prefix"].combine_chunks()
        parts = [np.asarray(prefixes[int(i)].values).view(np.uint64) for i in first]
        self.token = np.concatenate(parts)
        size = [len(p) for p in parts]
        self.node = np.repeat(nodes, size)
        self.n = np.repeat(np.asarray(table["n"])[first], size)
        self.pos = np.concatenate([np.arange(k) for k in size])


def _lists(sets: DataFrame) -> DataFrame:
    """token, node, n and pos of the prefix tokens that two nodes share."""
    total = sets.agg(F.sum(F.size("prefix")).alias("n")).first()["n"] or 0
    chunks = max(1, -(-total // CHUNK_TOKENS))
    nodes = sets.filter("prefix IS NOT NULL").select(F.pmod("node", F.lit(chunks)).cast("int").alias("chunk"), "node", "n", "prefix")
    kept = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("pos", pa.int64())])

    def first(table: pa.Table) -> pa.Table:
        c = _Chunk(table)
        return ask(table["chunk"][0].as_py(), codes(c.token, chunks), c.node, chunks)

    def second(table: pa.Table, said: pa.Table) -> pa.Table:
        if not len(table) or not len(said):
            return arrow_table(kept, [])
        c = _Chunk(table)
        keep = np.isin(codes(c.token, chunks), answers(said))
        return pa.table([pa.array(x[keep]) for x in (c.token.view(np.int64), c.node, c.n, c.pos)], schema=kept)

    said = nodes.groupBy("chunk").applyInArrow(first, ddl(ASKED)).groupBy("shard").applyInArrow(answer, ddl(SAID))
    return nodes.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInArrow(second, ddl(kept))


def _members_filter(wanted: DataFrame) -> np.ndarray:
    """One bit a hash of the wanted ids, in an array sized by their number. Other ids on a bit only let more rows pass."""
    total, count = FILTER_LEAST, wanted.count()
    while total < min(FILTER_MOST, FILTER_SHARE * count):
        total *= 2
    width = total // FILTER_SLICES

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width, np.uint8)
        bits[pdf["bit"].to_numpy()] = 1
        return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "bits": [np.packbits(bits).tobytes()]})

    at = F.pmod(F.xxhash64("doc_id"), F.lit(total))
    marks = wanted.select(F.floor(at / width).cast("int").alias("slice"), (at % width).cast("int").alias("bit")).distinct()
    out = np.zeros((FILTER_SLICES, width // 8), np.uint8)
    for r in marks.groupBy("slice").applyInPandas(mark, "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and its set, for the nodes in ``wanted`` (doc_id of a member, node). Texts are read, not moved."""
    filled = _members_filter(wanted)
    bits = docs.sparkSession.sparkContext.broadcast(filled)
    schema = pa.schema([("member", pa.int64()), ("known", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            at = np.asarray(batch.column(2))
            inside = (bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            for part in text_batches([batch.filter(pa.array(inside.astype(bool)))], 1, BATCH_BYTES):
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    hashes = shingle_set(text.encode() if text else b"", size)
                    rows.append((doc_id, _node(hashes) if len(hashes) else None, hashes.view(np.int64)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    marked = docs.withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(8 * len(filled))))
    held = marked.mapInArrow(run, "member long, known long, hashes array<long>")
    return held.join(wanted, (F.col("known") == F.col("node")) & F.col("member").eqNullSafe(F.col("doc_id"))).select("node", "hashes")


def _beside(percent: int):
    """Neighbours in sorted lists whose sizes allow a link. Those that two tasks part are left to the later readings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            got = [np.asarray(batch.column(c)) for c in ("token", "n", "node")]
            token, n, node = got if last is None else [np.r_[x, y] for x, y in zip(last, got, strict=True)]
            last = [x[-1:] for x in (token, n, node)]
            near = np.flatnonzero((token[1:] == token[:-1]) & (node[1:] != node[:-1]) & (100 * n[:-1] >= percent * n[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(node[1:][near]), pa.array(node[:-1][near])], names=["node", "prev"])

    return run


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and parity bits allow the threshold."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    total = F.col("na") + F.col("nb")
    least = F.ceil(F.lit(percent) * total / (100 + percent))
    fits = F.when(F.size("pa") == F.size("pb"), differ <= total - 2 * least).otherwise(F.lit(True))
    return both.filter((F.least("na", "nb") >= least) & fits).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    left, right = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    return both.filter(100 * shared >= percent * (F.size("ha") + F.size("hb") - shared)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and its component (smallest node reachable), for all nodes of ``edges`` (a, b).

    Trees of labels are hooked and flattened: in a round every node looks at the labels' labels of its
    neighbours, takes the smallest, and so does its own label, which carries all nodes below it along.
    Rounds grow with the logarithm of the longest path. Labels are written after each round, so neither
    lineage nor recomputation grows.
    """
    edges = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    first = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label"))

    def lifted(labels: DataFrame) -> DataFrame:
        """With the label's own label, and whether the tree still moves."""
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        return written(labels.join(up, "label"), "labels")

    labels = lifted(first.withColumn("moved", F.lit(True)))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("up").alias("seen"))
        around = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        near = labels.join(around, "node").select("node", "label", F.least("label", "up", "seen").alias("own"), "seen")
        hooks = near.groupBy(F.col("label").alias("node")).agg(F.min("seen").alias("hook"))
        now = near.join(hooks, "node", "left").select("node", F.least("own", F.coalesce("hook", "own")).alias("new"), "label")
        labels = lifted(now.select("node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")))
        if labels.filter("moved OR up != label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))


class _Lists:
    """Rows of several lists (token, n, pos, node, component, block), sorted, and the parity bits of their nodes."""

    def __init__(self, rows: pa.Table, parities: pa.Table, percent: int):
        token, n, pos, node, component, block = (np.asarray(rows[c]) for c in ("token", "n", "pos", "node", "component", "block"))
        order = np.lexsort([node, pos, n, token])
        self.token, self.n, self.pos, self.block, self.percent = token[order], n[order], pos[order], block[order], percent
        self.nodes, first, self.at = np.unique(node[order], return_index=True, return_inverse=True)
        self.size, self.component = self.n[first], component[order][first]
        bits = dict(zip(parities["node_of"].to_pylist(), parities["parity"].combine_chunks(), strict=True))
        self.bits = [np.asarray(bits[k].values).view(np.uint64) for k in self.nodes.tolist()]
        self.words = np.array([len(b) for b in self.bits])

    def _fits(self, i: np.ndarray, j: np.ndarray, across: bool) -> np.ndarray:
        """Which places i and j of a list (j before i, so no larger) hold a pair that sizes and positions allow."""
        least = -(-self.percent * (self.n[i] + self.n[j]) // (100 + self.percent))
        fits = (self.component[self.at[i]] != self.component[self.at[j]]) & (self.n[i] - self.pos[i] >= least) & (self.n[j] - self.pos[j] >= least)
        return fits & (self.block[i] != self.block[j]) if across else fits

    def _codes(self, across: bool) -> Iterator[np.ndarray]:
        """Codes of the lists' pairs across components that sizes and positions allow."""

        def code(i, j):
            x, y = self.at[i], self.at[j]
            return np.minimum(x, y) * len(self.nodes) + np.maximum(x, y)

        starts = np.flatnonzero(np.r_[True, np.diff(self.token) != 0])
        lengths = np.diff(np.r_[starts, len(self.token)])
        place = np.arange(len(self.token)) - np.repeat(starts, lengths)
        short = np.repeat(lengths <= SHORT_LIST, lengths)
        i = np.flatnonzero(short)
        for back in range(1, SHORT_LIST):
            i = i[place[i] >= back]
            if not len(i):
                break
            fits = self._fits(i, i - back, across)
            yield code(i[fits], i[fits] - back)
        for s, length in zip(starts[lengths > SHORT_LIST].tolist(), lengths[lengths > SHORT_LIST].tolist(), strict=True):
            n = self.n[s : s + length]
            lows = np.searchsorted(n, -(-self.percent * n // 100)).tolist()
            for i in range(1, length):
                if lows[i] < i:
                    j = np.arange(s + lows[i], s + i)
                    j = j[self._fits(np.full(len(j), s + i), j, across)]
                    if len(j):
                        yield code(np.full(len(j), s + i), j)

    def _alike(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that parity bits allow, and how much they seem to differ, as a share of what a link may."""
        i, j = codes // len(self.nodes), codes % len(self.nodes)
        total, share = self.size[i] + self.size[j], np.zeros(len(codes))
        most = total - 2 * -(-self.percent * total // (100 + self.percent))
        keep = self.words[i] != self.words[j]
        for w in np.unique(self.words[i[~keep]]).tolist():
            own = np.flatnonzero((self.words[i] == w) & (self.words[j] == w))
            for part in np.array_split(own, 1 + len(own) * w // (1 << 20)):
                x, y = np.stack([self.bits[k] for k in i[part]]), np.stack([self.bits[k] for k in j[part]])
                differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                # of d differing shingles on m places, about m/2 (1 - exp(-2d/m)) places differ
                seems = -32 * w * np.log(np.maximum(1 - differ / (32 * w), 1e-9))
                keep[part], share[part] = differ <= most[part], seems / np.maximum(most[part], 1)
        return codes[keep], share[keep]

    def pairs(self, across: bool, few: int | None) -> tuple[np.ndarray, np.ndarray, bool]:
        """Nodes (a < b) of the pairs, which of them form the forest, and whether others are left out."""
        kept, shares, held, count = np.empty(0, np.int64), np.empty(0), [], 0

        def settle():
            nonlocal kept, shares, held, count
            if held:
                fresh, share = self._alike(np.setdiff1d(np.concatenate(held), kept))
                kept, shares, held, count = np.r_[kept, fresh], np.r_[shares, share], [], 0

        for codes in self._codes(across):
            held.append(codes)
            count += len(codes)
            if count > HELD_PAIRS:
                settle()
        settle()
        forest = np.isin(kept, self._forest(kept, shares))
        left_out = few is not None and len(kept) > few * len(self.nodes)
        if left_out:
            kept, forest = kept[forest], forest[forest]
        return np.stack([self.nodes[kept // len(self.nodes)], self.nodes[kept % len(self.nodes)]]), forest, left_out

    def _forest(self, codes: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Of the pairs that seem to be links, a subset that joins all components they join, the most alike first."""
        top = {c: c for c in np.unique(self.component).tolist()}

        def root(c):
            while top[c] != c:
                top[c] = c = top[top[c]]
            return c

        out, likely = [], shares <= SEEMS
        for code in codes[likely][np.lexsort([codes[likely], shares[likely]])].tolist():
            x, y = (root(self.component[k].item()) for k in divmod(code, len(self.nodes)))
            if x != y:
                top[x] = y
                out.append(code)
        return np.array(out, np.int64)


_FOUND = "k long, x int, y int, a long, b long, forest boolean"


def _dealt(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists that several components share, dealt to tasks (k, x, y)."""
    known = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rows")).filter("low != high")
    several = written(several.select("token", "low", "rows"), "several")
    short, long = several.filter(F.col("rows") <= GROUP_ROWS), several.filter(F.col("rows") > GROUP_ROWS)
    parts = written(short.groupBy("low").agg(F.ceil(F.sum("rows") / GROUP_ROWS).alias("parts"), F.sum("rows").alias("all")), "parts")
    # families that one task can take share a task by hash, in bundles of about GROUP_ROWS
    bundles = -(-(parts.filter("parts = 1").agg(F.sum("all").alias("n")).first()["n"] or 1) // GROUP_ROWS)
    family = F.when(F.col("parts") > 1, F.col("low")).otherwise(F.pmod(F.xxhash64("low"), F.lit(bundles)))
    part = F.pmod(F.xxhash64("token"), F.col("parts")).cast("int")
    short = short.join(parts, "low").select("token", family.alias("k"), part.alias("x"), F.lit(-1).alias("y"), F.lit(1).alias("blocks"))
    long = long.select("token", F.col("token").alias("k"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("blocks"))
    rows = known.join(short.union(long), "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    columns = ["k", "x", "y", "token", "n", "pos", "node", "component", "block"]
    # a set of a long list meets every block of it
    met = rows.filter("y = 0").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    return written(rows.filter("y = -1").select(columns).union(met.select(columns)), "rest")


def _found(rows: DataFrame, nodes: DataFrame, percent: int, few: int | None) -> DataFrame:
    """Pairs (a < b) that each task's lists allow, its forest marked; a null pair where it gave the forest only."""
    parities = rows.select(F.col("k").alias("pk"), F.col("x").alias("px"), F.col("y").alias("py"), "node").distinct().join(nodes.select("node", "parity"), "node")
    parities = parities.toDF("node_of", "pk", "px", "py", "parity")
    kinds = {"k": pa.int64(), "x": pa.int32(), "y": pa.int32(), "a": pa.int64(), "b": pa.int64(), "forest": pa.bool_()}

    def run(key: tuple, rows: pa.Table, parities: pa.Table) -> pa.Table:
        k, x, y = (v.as_py() for v in key)
        ends, forest, left_out = _Lists(rows, parities, percent).pairs(y > x, few)
        columns = [[k] * len(forest), [x] * len(forest), [y] * len(forest), ends[0], ends[1], forest]
        if left_out:
            columns = [[*c, v] for c, v in zip(columns, (k, x, y, None, None, False), strict=True)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return written(rows.groupBy("k", "x", "y").cogroup(parities.groupBy("pk", "px", "py")).applyInArrow(run, _FOUND), "found")


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are in different components."""
    side = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def jaccard_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every document.

    Documents link when 100 * intersection >= percent * union of their sets of ``size``-word shingles.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = _nodes(docs, size, percent)
    nodes = sets.filter("prefix IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("parity").alias("parity"))
    members = sets.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    lists = written(_lists(sets), "lists")

    # one pair a set: the neighbour that it has in most of its lists
    places = ["token", "n", "pos", "node"]
    beside = lists.select(places).repartitionByRange(*places).sortWithinPartitions(*places).mapInArrow(_beside(percent), "node long, prev long")
    often = beside.groupBy("node", "prev").agg(F.count("*").alias("times"))
    best = often.groupBy("node").agg(F.max_by("prev", F.struct("times", "prev")).alias("prev"))
    first = best.select(F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b")).distinct()
    first = written(_possible(first, nodes, percent), "pairs")
    whole = written(_whole_sets(docs, _members_of(first, members), size), "whole")
    links = written(_verified(first, whole, percent), "links")
    labels = components(links)

    tested = first

    def merge(pairs: DataFrame) -> None:
        """Verify pairs that weren't, and merge the components of those that link."""
        nonlocal whole, links, labels, tested
        more = written(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            return
        missing = written(_members_of(more, members).join(whole.select("node").distinct(), "node", "left_anti"), "missing")
        if not missing.isEmpty():
            whole = whole.union(written(_whole_sets(docs, missing, size), "whole"))
        links = links.union(written(_verified(more, whole, percent), "links"))
        labels, tested = components(links), tested.union(more)

    rest = _dealt(lists, labels)
    found = _found(rest, nodes, percent, FEW)
    merge(found.filter("forest").select("a", "b"))
    merge(_between(found.filter("a IS NOT NULL AND NOT forest").select("a", "b"), labels))
    again = found.filter("a IS NULL").select("k", "x", "y")
    if not again.isEmpty():
        rest = rest.join(again, ["k", "x", "y"], "left_semi").drop("component").join(labels, "node", "left")
        merge(_found(rest.withColumn("component", F.coalesce("component", "node")), nodes, percent, None).select("a", "b"))

    placed = sets.select("doc_id", "n", "node").join(labels, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _members_of(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """doc_id of a member and node, for the nodes of the pairs."""
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(members, "node").select("doc_id", "node")
