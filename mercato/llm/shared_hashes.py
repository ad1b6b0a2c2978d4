"""Which hashes occur under two owners: chunks ask shards, with hashes packed into arrays.

A chunk sends its distinct hashes to the shards that they belong to, 32 bits each, with a bit for those
that two of its own members hold; a shard answers each chunk with those that two members anywhere hold.
Rows number chunks times shards at most, and never more than the hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
ASKED = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("shared", pa.binary())])
SAID = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def arrow_table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def codes(value: np.ndarray, shards: int) -> np.ndarray:
    """Shard and 32 bits of each 64-bit hash, as one number."""
    return (((value >> _U(32)) % _U(shards)) << _U(32)) | ((value * _U(0x94D049BB133111EB)) >> _U(32))


def ask(chunk: int, code: np.ndarray, owner: np.ndarray, shards: int) -> pa.Table:
    """A chunk's rows for the shards: its distinct codes, and which of them two owners hold."""
    if not len(code):
        return arrow_table(ASKED, [])
    order = np.lexsort([owner, code])
    code, owner = code[order], owner[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    ends = np.r_[starts[1:], len(code)]
    two, distinct = owner[starts] != owner[ends - 1], code[starts]
    cuts = np.searchsorted((distinct >> _U(32)).astype(np.int64), np.arange(shards + 1)).tolist()
    low = (distinct & _U(0xFFFFFFFF)).astype("<u4")
    return arrow_table(ASKED, [(s, chunk, low[a:b].tobytes(), np.packbits(two[a:b]).tobytes()) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a])


def answer(asked: pa.Table) -> pa.Table:
    """A shard's rows for the chunks: those of their hashes that two owners hold."""
    lists = [np.frombuffer(b, "<u4") for b in asked["hashes"].to_pylist()]
    own = [np.unpackbits(np.frombuffer(b, np.uint8))[: len(h)].astype(bool) for b, h in zip(asked["shared"].to_pylist(), lists, strict=True)]
    every = np.sort(np.concatenate(lists))
    several = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *[h[o] for h, o in zip(lists, own, strict=True)]]))
    shard, rows = asked["shard"][0].as_py(), []
    for c, h in zip(asked["chunk"].to_pylist(), lists, strict=True):
        at = np.minimum(np.searchsorted(several, h), len(several) - 1)  # both are sorted
        got = h[several[at] == h] if len(several) else h[:0]
        if len(got):
            rows.append((c, shard, 1, got.tobytes()))
    return arrow_table(SAID, rows)


def answers(said: pa.Table) -> np.ndarray:
    """The codes that shards named to a chunk."""
    parts = [(_U(s) << _U(32)) | np.frombuffer(b, "<u4").astype(_U) for s, p, b in zip(said["shard"].to_pylist(), said["part"].to_pylist(), said["data"].to_pylist(), strict=True) if p == 1]
    return np.concatenate(parts) if parts else np.empty(0, _U)
