"""Removal of byte strings that an earlier document holds, by suffix arrays over shards of candidates.

A string of ``LENGTH`` bytes can only repeat where the least hash of its ``GRAM``-byte grams repeats, so
texts are cut at those least hashes: consecutive windows (strings of LENGTH bytes) with the same least hash
make one run. Equal windows have equal hashes and meet in the same shard.

1. Documents are dealt by hash into chunks. Each chunk sends its distinct hashes to shards, packed into
   arrays; a shard answers which of them two documents share.
2. Chunks send the bytes of runs under shared hashes, each distinct run once with the smallest and largest
   id that holds it. A shard sorts the suffixes of its distinct runs by induced sorting, cuts the order
   where the permuted common prefixes fall below LENGTH, takes the smallest id of each group, and answers
   for runs whose windows an earlier document holds.
3. Chunks cover those windows in their documents and cut the covered bytes out.

Copies, however many, send each run once a chunk. Documents cross the network once: the three steps share
one exchange. Numbers of chunks and shards follow from the bytes to work on.

Defined cases: null text is empty; texts under LENGTH bytes stay; null ids come after all others, so they
lose to any id; equal ids are not smaller than each other; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared_hashes import ASKED, SAID, answer, answers, arrow_table, ask, codes, ddl
from mercato.llm.suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 50, 24
CHUNK_BYTES = 4 << 20
SHARDS_A_CHUNK = 2
LAST = np.iinfo(np.int64).max

_U = np.uint64
_SENT = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("numbers", pa.binary()), ("lengths", pa.binary()), ("least", pa.binary()), ("most", pa.binary()), ("body", pa.binary())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def least_hashes(body: np.ndarray) -> np.ndarray:
    """For each window of LENGTH bytes the least hash of the grams inside it."""
    if len(body) < LENGTH:
        return np.empty(0, _U)
    words = np.ndarray((len(body) - 7,), "<u8", body.tobytes(), strides=(1,)).copy()
    n = len(body) - GRAM + 1
    h = words[:n] * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(32)
    for k in range(8, GRAM, 8):
        h = (h + words[k : k + n]) * _U(0xC2B2AE3D27D4EB4F)
        h ^= h >> _U(29)
    width, span = 1, LENGTH - GRAM + 1
    while width * 2 <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (span - width)], h[span - width :])


class Runs:
    """The runs of a chunk's documents, in a fixed order: value, document, first window and windows."""

    def __init__(self, chunk: pa.Table):
        order = np.lexsort([np.array([hash_of(b) for b in chunk["body"].to_pylist()], np.int64), np.asarray(chunk["doc_id"].fill_null(LAST))])
        self.ids = np.asarray(chunk["doc_id"].fill_null(LAST))[order]
        self.real = np.asarray(chunk["doc_id"].is_valid())[order]
        bodies = chunk["body"].to_pylist()
        self.bodies = [np.frombuffer(bodies[i], np.uint8) for i in order.tolist()]
        value, doc, at, windows = [], [], [], []
        for d, body in enumerate(self.bodies):
            m = least_hashes(body)
            if len(m):
                starts = np.r_[0, np.flatnonzero(m[1:] != m[:-1]) + 1]
                value.append(m[starts])
                doc.append(np.full(len(starts), d))
                at.append(starts)
                windows.append(np.diff(np.r_[starts, len(m)]))
        pick = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        self.value, self.doc, self.at, self.windows = pick(value, _U), pick(doc, np.int64), pick(at, np.int64), pick(windows, np.int64)

    def shared(self, code: np.ndarray, wanted: np.ndarray) -> tuple[dict[tuple[int, bytes], int], np.ndarray, np.ndarray]:
        """Numbers of the distinct runs under shared hashes, and for each occurrence its number and place."""
        keep = np.flatnonzero(np.isin(code, wanted))
        numbers: dict[tuple[int, bytes], int] = {}
        which = np.empty(len(keep), np.int64)
        cells = (code[keep] >> _U(32)).astype(np.int64).tolist()
        for k, (i, shard) in enumerate(zip(keep.tolist(), cells, strict=True)):
            start = self.at[i]
            text = self.bodies[self.doc[i]][start : start + self.windows[i] + LENGTH - 1].tobytes()
            which[k] = numbers.setdefault((shard, text), len(numbers))
        return numbers, which, keep


def hash_of(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def _ask(shards: int) -> Callable[[pa.Table], pa.Table]:
    """Step 1, chunk: its distinct hashes by shard, and which of them two of its documents share."""

    def run(chunk: pa.Table) -> pa.Table:
        runs = Runs(chunk)
        return ask(chunk["chunk"][0].as_py(), codes(runs.value, shards), runs.ids[runs.doc], shards)

    return run


def _send(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 2, chunk: its distinct runs under shared hashes, with the smallest and largest id of each."""

    def run(chunk: pa.Table, said: pa.Table) -> pa.Table:
        if not len(chunk) or not len(said):
            return arrow_table(_SENT, [])
        runs = Runs(chunk)
        numbers, which, keep = runs.shared(codes(runs.value, shards), answers(said))
        ids = runs.ids[runs.doc[keep]]
        least, most = np.full(len(numbers), LAST), np.full(len(numbers), np.iinfo(np.int64).min)
        np.minimum.at(least, which, ids)
        np.maximum.at(most, which, ids)
        by: dict[int, list] = {}
        for (shard, text), k in numbers.items():
            by.setdefault(shard, []).append((k, text))
        me, rows = chunk["chunk"][0].as_py(), []
        for shard, items in by.items():
            k = np.array([i for i, _ in items], "<i4")
            rows.append((shard, me, k.tobytes(), np.array([len(t) for _, t in items], "<i4").tobytes(), least[k].tobytes(), most[k].tobytes(), b"".join(t for _, t in items)))
        return arrow_table(_SENT, rows)

    return run


def earliest(texts: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that holds each window of ``texts``, by place in them joined; and each text's place.

    Texts are joined by a separator that no window spans; ``ids`` are the smallest ids of the texts.
    """
    body = np.frombuffer(b"\0".join(texts) + bytes(LENGTH + 8), np.uint8)
    size = np.array([len(t) for t in texts])
    starts = np.r_[0, np.cumsum(size + 1)[:-1]]
    end = int(starts[-1] + size[-1])
    used = np.bincount(body[:end], minlength=256) > 0
    dense = np.cumsum(used).astype(np.int32) + 1  # bytes that occur, from 2 on
    symbols = dense[body[: end + 1]]
    symbols[starts[1:] - 1] = 1
    symbols[end] = 0
    order = suffix_array(symbols, int(used.sum()) + 2, LENGTH)
    owner = np.repeat(np.arange(len(texts)), size + 1)
    window = np.arange(end + 1) - starts[owner] <= size[owner] - LENGTH
    order = order[window[order]]
    same = common_prefixes(body, order, LENGTH)[order]
    same[0] = False
    groups = np.flatnonzero(~same)
    low = np.minimum.reduceat(ids[owner[order]], groups)
    out = np.full(end + 1, LAST)
    out[order] = np.repeat(low, np.diff(np.r_[groups, len(order)]))
    return out, starts


def _resolve(sent: pa.Table) -> pa.Table:
    """Step 2, shard: to each chunk the runs that an earlier document holds, with the smallest ids by window."""
    known: dict[bytes, int] = {}
    ids: list[int] = []
    chunks = []
    for row in sent.to_pylist():
        size, at, own = np.frombuffer(row["lengths"], "<i4").tolist(), 0, []
        for n, low in zip(size, np.frombuffer(row["least"], np.int64).tolist(), strict=True):
            text = row["body"][at : at + n]
            at += n
            k = known.setdefault(text, len(known))
            if k == len(ids):
                ids.append(low)
            elif low < ids[k]:
                ids[k] = low
            own.append(k)
        chunks.append((row["chunk"], np.frombuffer(row["numbers"], "<i4"), np.array(own), np.frombuffer(row["most"], np.int64)))
    texts = list(known)
    low, starts = earliest(texts, np.array(ids))
    windows = np.array([len(t) for t in texts]) - LENGTH + 1
    least = np.minimum.reduceat(low, starts)  # places that start no window hold the largest id
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    shard, rows = sent["shard"][0].as_py(), []
    for chunk, numbers, own, most in chunks:
        hit = np.flatnonzero(least[own] < most)
        if not len(hit):
            continue
        # each run's windows, cut where their smallest id changes
        s, e = starts[own[hit]], starts[own[hit]] + windows[own[hit]]
        inner, past = np.searchsorted(change, s, "right"), np.searchsorted(change, e, "left")
        count = past - inner + 1
        run = np.repeat(np.arange(len(hit)), count)
        k = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        bounds = np.append(change, len(low))
        a = np.where(k == 0, s[run], bounds[np.maximum(inner[run] + k - 1, 0)])
        z = np.where(k == count[run] - 1, e[run], bounds[np.minimum(inner[run] + k, len(change))])
        told = np.column_stack([numbers[hit][run], a - s[run], z - s[run], low[a]]).astype(np.int64)
        rows.append((chunk, shard, 2, told.tobytes()))
    return arrow_table(SAID, rows)


def _cut(shards: int, with_kept: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 3, chunk: its documents without the windows that earlier documents hold."""

    def run(chunk: pa.Table, said: pa.Table) -> pa.Table:
        if not len(chunk):
            return arrow_table(_ROWS, [])
        runs = Runs(chunk)
        cover = [np.zeros(len(b) + 1, np.int32) if len(b) >= LENGTH else None for b in runs.bodies]
        told = [np.frombuffer(b, np.int64).reshape(-1, 4) for p, b in zip(said["part"].to_pylist(), said["data"].to_pylist(), strict=True) if p == 2]
        if told:
            told = np.concatenate(told)
            told = told[np.argsort(told[:, 0], kind="stable")]
            _, which, keep = runs.shared(codes(runs.value, shards), answers(said))
            low, high = np.searchsorted(told[:, 0], which), np.searchsorted(told[:, 0], which, "right")
            times = high - low
            each = np.repeat(np.arange(len(which)), times)
            row = told[np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())]
            doc, at = runs.doc[keep][each], runs.at[keep][each]
            hit = row[:, 3] < runs.ids[doc]
            doc, a, b = doc[hit], (at + row[:, 1])[hit], (at + row[:, 2])[hit] + LENGTH - 1
            order = np.argsort(doc, kind="stable")
            doc, a, b = doc[order], a[order], b[order]
            cuts = np.r_[0, np.flatnonzero(np.diff(doc)) + 1, len(doc)] if len(doc) else np.zeros(1, int)
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                np.add.at(cover[doc[s]], a[s:e], 1)
                np.add.at(cover[doc[s]], b[s:e], -1)
        rows = []
        for d, body in enumerate(runs.bodies):
            gone = np.cumsum(cover[d][:-1]) > 0 if cover[d] is not None else np.zeros(len(body), bool)
            kept = body[~gone].tobytes()
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
            rows.append((int(runs.ids[d]) if runs.real[d] else None, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        return arrow_table(_ROWS, rows)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_kept: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (remaining bytes; null unless asked for)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"))
    total = rows.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    chunks = max(1, -(-total // chunk_bytes))
    shards = chunks * SHARDS_A_CHUNK
    chunk = F.pmod(F.xxhash64("doc_id", F.octet_length("body"), F.crc32("body")), F.lit(chunks)).cast("int")
    rows = rows.select(chunk.alias("chunk"), "doc_id", "body")
    asked = rows.groupBy("chunk").applyInArrow(_ask(shards), ddl(ASKED))
    said = asked.groupBy("shard").applyInArrow(answer, ddl(SAID))
    sent = rows.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInArrow(_send(shards), ddl(_SENT))
    told = sent.groupBy("shard").applyInArrow(_resolve, ddl(SAID))
    return rows.groupBy("chunk").cogroup(said.union(told).groupBy("chunk")).applyInArrow(_cut(shards, with_kept), ddl(_ROWS))
