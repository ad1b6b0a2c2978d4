"""Packing documents into fixed-length token sequences with a bounded number of open windows.

Each task reads its documents once and keeps ``OPEN`` unfinished windows. Whole windows of a long
document are emitted at once; its rest goes into the open window it fits best. When none fits, the
fullest is emitted: as it is if at most ``SLACK`` places are free, else topped up with the head of
the document, whose tail goes on. Only the places of pieces are kept, never their tokens.

What stays open at the end of a task is merged in rounds: the windows left by ``FAN`` tasks are packed
again by the same rule, until one group of at most ``OPEN`` windows remains. Its pieces are cut to fill
whole sequences, and the last rest to sequences whose lengths are powers of two, which need no padding.

Defined cases: null text is empty and packs as the end token alone; repeated rows are packed each;
null ids are carried; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import text_batches, written

SEQUENCE = 4096
END_ID = 2
OPEN = 32
SLACK = 16
FAN = 32
#: Words whose ids a Python worker remembers before it starts anew.
REMEMBERED = 1_500_000
BATCH_BYTES = 8 << 20

_ROW = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, window long, offset long, ids binary"
_NAMES = [f.split()[0] for f in _ROW.split(", ")]
_ARROW = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in _NAMES])


class WordIds(dict):
    """Word (UTF-8) -> its token ids as little-endian unsigned 32-bit bytes, filled on demand.

    The tokenizer drops white space and treats the words between it apart, so ids of a text are the ids
    of its words in order. A final comma or stop after a letter is a token of its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > 1 and word[-1:] in (b",", b".") and word[-2:-1].isalpha():
            got = self[word[:-1]] + self[word[-1:]]
        else:
            ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
            got = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = got
        return got

    def ids(self, text: bytes) -> bytes:
        """Ids of a text. Case of A-Z doesn't matter to the tokenizer, except in its special tokens' names."""
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file; kept from task to task."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


class Windows:
    """Bounded-space best fit over pieces (doc_id, start, ids, doc_tokens); ``rows`` gathers what is emitted."""

    def __init__(self, part: int, sequence: int = SEQUENCE):
        self.part, self.sequence = part, sequence
        self.open: list[list] = []  # [used, pieces]
        self.made = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int) -> None:
        def cut(n: int) -> tuple:
            nonlocal start, ids
            head, start, ids = (doc_id, start, ids[: 4 * n], doc_tokens), start + n, ids[4 * n :]
            return head

        if len(ids) >= 4 * self.sequence:
            whole, at = memoryview(ids), 0
            for at in range(0, len(ids) - 4 * self.sequence + 1, 4 * self.sequence):
                self._emit([(doc_id, start + at // 4, bytes(whole[at : at + 4 * self.sequence]), doc_tokens)])
            at += 4 * self.sequence
            start, ids = start + at // 4, ids[at:]
        while length := len(ids) // 4:
            fits = [w for w in self.open if w[0] + length <= self.sequence]
            if fits:
                return self._put(max(fits, key=lambda w: w[0]), cut(length))
            if len(self.open) < OPEN:
                return self.open.append([length, [cut(length)]])
            full = max(self.open, key=lambda w: w[0])
            gap = self.sequence - full[0]
            if gap > SLACK:
                self._put(full, cut(gap))
            else:
                self._close(full)
        return None

    def _put(self, window: list, piece: tuple) -> None:
        window[0] += len(piece[2]) // 4
        window[1].append(piece)
        if window[0] == self.sequence:
            self._close(window)

    def _close(self, window: list) -> None:
        self.open = [w for w in self.open if w is not window]
        self._emit(window[1])

    def _emit(self, pieces: list[tuple], unfinished: bool = False) -> None:
        at = 0
        for doc_id, start, ids, doc_tokens in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), doc_tokens, self.part, self.made, at, ids if unfinished else None))
            at += length
        self.made += 1

    def leave(self) -> None:
        """Emit what is open as unfinished."""
        for window in self.open:
            self._emit(window[1], unfinished=True)
        self.open = []

    def finish(self) -> None:
        """Cut what is open into whole sequences and a rest of powers of two."""
        pieces, self.open = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]][::-1], []
        left = sum(len(p[2]) // 4 for p in pieces)
        sizes = [self.sequence] * (left // self.sequence) + [1 << k for k in reversed(range(self.sequence.bit_length())) if (left % self.sequence) >> k & 1]
        for size in sizes:
            window = []
            while size:
                doc_id, start, ids, doc_tokens = pieces.pop()
                take = min(size, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * take], doc_tokens))
                size -= take
                if 4 * take < len(ids):
                    pieces.append((doc_id, start + take, ids[4 * take :], doc_tokens))
            self._emit(window)

    def given(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _by_task(path: str, sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, windows = word_ids(path), Windows(TaskContext.get().partitionId(), sequence)
        end = END_ID.to_bytes(4, "little")

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

        for batch in text_batches(batches, 1, BATCH_BYTES):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = known.ids(text.as_py().encode() if text.is_valid else b"") + end
                windows.add(doc_id, 0, ids, len(ids) // 4)
            if rows := windows.given():
                yield batch_of(rows)
        windows.leave()
        if rows := windows.given():
            yield batch_of(rows)

    return run


def _merge(sequence: int, last: bool):
    def run(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        windows = Windows(key[0], sequence)
        for r in left.sort_values(["part", "window", "offset"]).itertuples():
            windows.add(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), r.ids, int(r.doc_tokens))
        windows.finish() if last else windows.leave()
        out = pd.DataFrame(windows.given(), columns=_NAMES)
        return out.astype({n: "Int64" for n in _NAMES if n != "ids"})

    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of the tokenizer file, the same on every executor.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    step = written(rows.mapInArrow(_by_task(tokenizer, sequence), _ROW), "packed-0")
    done, turn = [], 0
    while True:
        done.append(step.filter(F.col("ids").isNull()).withColumn("turn", F.lit(turn)))
        left = step.filter(F.col("ids").isNotNull())
        top = left.agg(F.max("part").alias("p")).first()["p"]
        if top is None:
            break
        turn += 1
        group = F.floor(F.col("part") / FAN).cast("long")
        step = written(left.groupBy(group.alias("g")).applyInPandas(_merge(sequence, last=top < FAN), _ROW), f"packed-{turn}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    place = F.shiftleft(F.col("turn").cast("long"), 58) + F.shiftleft(F.col("part"), 29) + F.col("window")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", place.alias("sequence_id"), "offset")
