"""Suffix arrays against sorted suffixes."""

import random

import numpy as np
import pytest

from mercato.llm.suffix_array import common_prefixes, suffix_array


def texts():
    rng = random.Random(4)
    yield from (b"", b"a", b"aaaaaaaaaaaaaaaaaaaaaaaaaaa", b"banana", b"mississippi", b"ab" * 40, b"ba" * 40 + b"a", bytes(range(256)) * 2)
    for k in (1, 2, 3, 20):
        for _ in range(60):
            yield bytes(rng.randrange(97, 97 + k) for _ in range(rng.randrange(200)))
    base = bytes(rng.randrange(256) for _ in range(120))
    yield base * 5 + b"x" + base


@pytest.mark.parametrize("depth", [4, 16, 50])
def test_order_to_depth(depth):
    for t in texts():
        symbols = np.append(np.frombuffer(t, np.uint8).astype(np.int32) + 1, 0)
        got = suffix_array(symbols, 257, depth)
        assert sorted(got.tolist()) == list(range(len(t) + 1))
        keys = [t[i : i + depth] for i in got.tolist()]
        assert keys == sorted(keys), t


def test_common_prefixes():
    for t in texts():
        order = suffix_array(np.append(np.frombuffer(t, np.uint8).astype(np.int32) + 1, 0), 257, 12)
        order = order[order + 12 <= len(t)]
        got = common_prefixes(np.frombuffer(t + bytes(32), np.uint8), order, 12)
        have = [t[i : i + 12] for i in order.tolist()]
        assert got.sum() == sum(a == b for a, b in zip(have, have[1:], strict=False))
