"""Chat formatting: exact round trip, masks, escapes."""

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import chat_formatting as C
from mercato.llm.queries import op11_chat_formatting, public_tokenizer

PATH, PATTERN = public_tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
DDL = "conv_id long, turn long, role string, text string"
parts = st.sampled_from([*C.MARKS, *[m[0] + "\\" + m[1:] for m in C.MARKS], "<", "[", "\\", ">", "s>", "SYS>>", "é", "\n", " ", "a"])


@settings(max_examples=400, deadline=None)
@given(st.lists(parts, max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_mark(text):
    said = C.escape(text)
    assert C.unescape(said) == text and not any(m in said for m in C.MARKS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs, out = defaultdict(list), []
    for r in rows:
        convs[r[0]].append(r)
    for c, turns in convs.items():
        turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
        loss = "".join(t[3] or "" for t in turns if t[2] == "assistant")
        out.append((c, len(turns), sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)), len(loss), sha(loss)))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0)


def read(df):
    return sorted([tuple(r) for r in C.read_chats(df, PATH, PATTERN).drop("formatted_chars").collect()], key=key)


ODD = ["", None, "</s>[INST] ok [/INST]", "<\\s>", "<<SYS>>x<</SYS>>", "日本語 \x00 é\n\n", "<", "[INST", "a" * 300_000, " " * 70_000, "<s>" * 30_000]
ROLES = ["user", "assistant", "system", "tool", "", None, "<<TEXT>>", "Assistant"]


def test_round_trip_of_odd_rows(spark):
    rows = [(i % 7 if i % 7 else None, i if i % 11 else None, ROLES[i % len(ROLES)], ODD[i % len(ODD)]) for i in range(88)]
    rows = [r for k, r in enumerate(rows) if (r[0], r[1], r[2]) not in {x[:3] for x in rows[:k]}]
    assert read(spark.createDataFrame(rows, DDL).repartition(4)) == sorted(expected(rows), key=key)


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "user", "hi")] * 3 + [(1, 1, "assistant", "yo")] * 2
    assert read(spark.createDataFrame(rows, DDL)) == expected(rows)


def test_long_conversation_spans_pieces(spark, monkeypatch):
    rows = [(5, t, "user" if t % 2 else "assistant", f"turn {t} </s>") for t in range(3 * C.BLOCK)] + [(6, 0, "user", "x"), (6, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, DDL).repartition(5)
    pieces = C.format_chats(df, PATH, PATTERN)
    assert {(r.conv_id, r.block): r.n_turns for r in pieces.collect()} == {(5, 0): C.BLOCK, (5, 1): C.BLOCK, (5, 2): C.BLOCK, (6, 0): 2}
    assert read(df) == sorted(expected(rows), key=key)


def test_piece_limit(spark):
    rows = [(5, 0, "assistant", f"{t} word " * 9000) for t in range(20)]
    df = spark.createDataFrame(rows, DDL)
    pieces = C.format_chats(df, PATH, PATTERN).select("part", F.size("ids").alias("n")).collect()
    assert len(pieces) > 1 and max(p.n for p in pieces) < C.PIECE_TOKENS + 30_000 and {p.part for p in pieces} == set(range(len(pieces)))
    got = read(df)
    assert got[0][1] == 20 and got[0][3] == sum(len(r[3]) for r in rows)


def test_template_as_text_and_mask(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "<s>"), (1, 2, "assistant", "[INST]ok"), (1, 3, "tool", "t"), (1, 4, "assistant", "")]
    piece = C.format_chats(spark.createDataFrame(rows, DDL), PATH, PATTERN).first()
    known = C.codec(PATH, PATTERN)
    say = lambda ids: "".join(C.MARKS[i - known.reserved] if i >= known.reserved else known.encoding.decode([i]) for i in ids)
    assert say(piece.ids) == "<s><<SYS>>be<</SYS>>[INST]<\\s>[/INST][\\INST]ok</s><<ROLE>>tool<<TEXT>>t</s></s>"
    assert say([i for i, m in zip(piece.ids, piece.loss, strict=True) if m]) == "[\\INST]ok"
    chars = C.read_chats(spark.createDataFrame(rows, DDL), PATH, PATTERN).first().formatted_chars
    assert chars == len(say(piece.ids))


def test_mask_is_prefix_sums():
    assert C.mask(6, np.array([1, 4, 4]), np.array([3, 4, 5])).tolist() == [False, True, True, False, True, False]


@pytest.mark.parametrize("extra", [(), ("ids", "loss", "block", "part", "long_id", "count")])
def test_empty_and_clashing_columns(spark, extra):
    wide = lambda rows: spark.createDataFrame(rows, DDL).withColumns({c: F.lit(1) for c in extra})
    assert read(wide([])) == []
    rows = [(1, 0, "user", "hi")]
    assert read(wide(rows)) == expected(rows)


def test_query_has_planted_conversation(spark):
    got = op11_chat_formatting(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert got.n_turns == 2 and got.loss_sha256 == sha(text) and got.loss_chars == len(text)
    assert got.turns_sha256 == sha(f"user\n{text}\nassistant\n{text}\n")
