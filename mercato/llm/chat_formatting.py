"""Chat formatting at token level: segments encoded apart, reserved ids between them, masks by prefix sums.

The template, as text (a turn's kind is told by its marks):

    <s>                              begins a piece
    [INST]text[/INST]                user
    <<SYS>>text<</SYS>>              system
    text</s>                         assistant
    <<ROLE>>role<<TEXT>>text</s>     any other role

Every mark is one reserved id beyond the tokenizer's vocabulary, which no text can encode to. As text, a
mark that occurs inside a content gets a backslash after its first character, one more where it has some
already, so that formatted text can be read back too; reading takes one off again.

Rows are encoded where they are read. What is shuffled are ids, by conversation and block of ``BLOCK``
turn numbers, so that a conversation without end is many groups. A task walks its sorted rows and emits
a piece (a run of whole turns of one conversation) at the end of a block, or when it holds
``PIECE_TOKENS``. Loss covers the ids of assistant texts: +1 where one starts, -1 where it ends, summed up.

Defined cases: null texts and roles are empty, a null role or an empty one being an 'other role'; null
conversation ids form one conversation; null turns come first; rows of equal turn follow by role, then
ids; repeated rows are turns each; texts longer than ``SEGMENT`` characters are encoded in parts of that
length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import text_batches, written

#: The marks; their reserved ids follow the vocabulary in this order.
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>"]
BEGIN, END, USER, USER_END, SYSTEM, SYSTEM_END, ROLE, TEXT = range(8)
BLOCK = 1024
#: Block of rows without a turn: before all others.
NO_TURN = -(1 << 62)
PIECE_TOKENS = 1 << 18
SEGMENT = 1 << 16
BATCH_BYTES = 4 << 20

_MARK = re.compile("|".join(rf"{re.escape(m[0])}(?:\\*)(?={re.escape(m[1:])})" for m in MARKS))
_ESCAPED = re.compile("|".join(rf"{re.escape(m[0])}(?:\\+)(?={re.escape(m[1:])})" for m in MARKS))


def escape(text: str) -> str:
    return _MARK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


class Codec:
    """Ids of texts by a tiktoken ranks file, and reserved ids for the marks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.reserved = max(ranks.values()) + 1
        #: Ids travel in as few bytes as the largest needs.
        self.packed = "<u2" if self.reserved + len(MARKS) <= 1 << 16 else "<u4"

    def ids(self, text: str) -> np.ndarray:
        parts = [self.encoding.encode_ordinary(text[a : a + SEGMENT]) for a in range(0, len(text), SEGMENT)]
        return np.array([i for p in parts for i in p], np.int32)

    def turn(self, role: str | None, text: str | None) -> tuple[np.ndarray, int, int]:
        """A turn's ids and the part of them that loss covers."""
        mark = lambda m: np.array([self.reserved + m], np.int32)
        body = self.ids(escape(text or ""))
        if role == "user":
            return np.concatenate([mark(USER), body, mark(USER_END)]), 0, 0
        if role == "system":
            return np.concatenate([mark(SYSTEM), body, mark(SYSTEM_END)]), 0, 0
        if role == "assistant":
            return np.concatenate([body, mark(END)]), 0, len(body)
        return np.concatenate([mark(ROLE), self.ids(escape(role or "")), mark(TEXT), body, mark(END)]), 0, 0

    def text(self, ids: np.ndarray) -> str:
        """Formatted text of ids without marks."""
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")

    def turns(self, ids: np.ndarray, loss: np.ndarray) -> Iterator[tuple[str, str, str | None, int]]:
        """Role, text, text under the loss mask (None without) and formatted length of every turn of a piece."""
        places = np.flatnonzero(ids >= self.reserved)
        role, length, at = None, 0, 0
        for place in places.tolist():
            mark, raw = int(ids[place]) - self.reserved, self.text(ids[at:place])
            length += len(raw) + len(MARKS[mark])
            if mark == TEXT:
                role = unescape(raw)
            elif mark in (END, USER_END, SYSTEM_END):
                said = {USER_END: "user", SYSTEM_END: "system", END: "assistant" if role is None else role}[mark]
                under = loss[at:place]
                masked = unescape(self.text(ids[at:place][under])) if under.any() else None
                yield said, unescape(raw), masked, length
                role, length = None, 0
            at = place + 1


_known: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a ranks file; kept from task to task."""
    if (path, pattern) not in _known:
        _known[path, pattern] = Codec(path, pattern)
    return _known[path, pattern]


def _encoded(path: str, pattern: str):
    names = ["conv_id", "turn", "role", "ids", "loss_from", "loss_upto"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern)
        for batch in text_batches(batches, 3, BATCH_BYTES):
            rows = [known.turn(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            ids = pa.array([r[0].astype(known.packed).tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=names)

    return run


_PIECE = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("n_turns", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))])
_PIECE_DDL = "conv_id long, block long, part int, n_turns long, ids array<int>, loss array<boolean>"


def mask(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True from each start up to its end: prefix sums of +1 and -1."""
    steps = np.zeros(length + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _assembled(begin: int, packed: str):
    """Pieces of sorted rows (conv_id, block, ids as bytes, loss_from, loss_upto)."""

    def piece(key: tuple, part: int, held: list) -> tuple:
        offsets = 1 + np.cumsum([0, *[len(h[0]) for h in held]])[:-1]
        every = np.concatenate([np.array([begin], np.int32), *[h[0] for h in held]])
        return (*key, part, len(held), every, mask(len(every), offsets + [h[1] for h in held], offsets + [h[2] for h in held]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, held, size, out, waiting = None, 0, [], 0, [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE)

        for batch in batches:
            for conv_id, block, ids, start, upto in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if held and (key != (conv_id, block) or size >= PIECE_TOKENS):
                    out.append(piece(key, part, held))
                    part, waiting, held, size = part + 1, waiting + size, [], 0
                if key != (conv_id, block):
                    key, part = (conv_id, block), 0
                held.append((np.frombuffer(ids, packed).astype(np.int32), start, upto))
                size += len(held[-1][0])
                if waiting > PIECE_TOKENS or len(out) >= 1000:
                    yield batch_of(out)
                    out, waiting = [], 0
        if held:
            out.append(piece(key, part, held))
        if out:
            yield batch_of(out)

    return run


def format_chats(chats: DataFrame, tokenizer: str, pattern: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, block, part, n_turns, ids and loss (a flag an id) of every conversation's pieces, in order of block and part.

    ``tokenizer``: path of a tiktoken ranks file, the same on every executor; ``pattern``: how it splits text.
    A conversation whose turn numbers share one block is one piece, unless it has more than ``PIECE_TOKENS``.
    """
    rows = chats.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    rows = rows.mapInArrow(_encoded(tokenizer, pattern), "conv_id long, turn long, role string, ids binary, loss_from int, loss_upto int")
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(NO_TURN)).cast("long"))
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "ids")
    known = codec(tokenizer, pattern)
    return dealt.select("conv_id", "block", "ids", "loss_from", "loss_upto").mapInArrow(_assembled(known.reserved + BEGIN, known.packed), _PIECE_DDL)


class _Reader:
    """Running digests of turns and of the text under the loss mask."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n, self.loss_chars, self.chars = 0, 0, 0

    def add(self, known: Codec, ids: np.ndarray, loss: np.ndarray) -> None:
        for role, text, masked, length in known.turns(ids, loss):
            self.turns.update(f"{role}\n{text}\n".encode())
            if masked is not None:
                self.loss.update(masked.encode())
                self.loss_chars += len(masked)
            self.n += 1
            self.chars += length

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_READ_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(path: str, pattern: str, chained: bool):
    """A row a piece, or a row a run of pieces of one conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reader, last, out = codec(path, pattern), None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

        for batch in batches:
            for conv_id, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if reader and not (chained and conv_id == last):
                    out.append((last, *reader.row()))
                    reader = None
                reader, last = reader or _Reader(), conv_id
                reader.add(known, np.asarray(ids.values), loss.values.to_numpy(zero_copy_only=False))
            if len(out) >= 1000:
                yield batch_of(out)
                out = []
        if reader:
            out.append((last, *reader.row()))
        if out:
            yield batch_of(out)

    return run


def read_chats(chats: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """What the formatted pieces of ``chats`` say when read back, a row a conversation.

    Columns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. Conversations of one piece
    are read where the piece is. Only those of several are formatted again and walked in order by one task
    each, which holds a piece at a time: a digest of a whole conversation can't be taken in parallel.
    """
    pieces = format_chats(chats, tokenizer, pattern).select("conv_id", "ids", "loss")
    single = written(pieces.mapInArrow(_read(tokenizer, pattern, chained=False), _READ_DDL), "chats")
    several = single.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("long_id"))
    several = written(several, "long-chats")
    if several.isEmpty():
        return single
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    again = format_chats(chats.join(several, is_long, "left_semi"), tokenizer, pattern)
    walked = again.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").select("conv_id", "ids", "loss")
    return single.join(several, is_long, "left_anti").union(walked.mapInArrow(_read(tokenizer, pattern, chained=True), _READ_DDL))
