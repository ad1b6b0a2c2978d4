"""Suffix arrays by induced sorting, in whole-array steps.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S of each
run (LMS) start substrings that are sorted by inducing; their names make a shorter string, whose
suffixes are ordered, and from that order all suffixes are induced: first the L suffixes by ascending
first symbol, then the S suffixes by descending one. Within a symbol's bucket everything already known
moves at once, and only runs of the same symbol take further rounds.

Orders are exact to ``depth`` symbols, which is all that common prefixes up to ``depth`` need. That bounds
the sort of the names: they are ranked by doubling until the names span ``depth`` symbols, as buckets no
longer pay where nearly every name has its own.
"""

from __future__ import annotations

import numpy as np


def _is_small(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one a place on; the last symbol is a unique smallest."""
    step = np.sign(np.diff(text))
    n = len(step)
    # a run of equal symbols takes the type of its end
    end = np.where(step != 0, np.arange(n), n)
    end = np.minimum.accumulate(end[::-1])[::-1]
    return np.append(np.append(step, 1)[end] > 0, True)


def _spread(places: np.ndarray, text: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Append places to their symbols' queues, keeping their order."""
    if not len(places):
        return
    symbol = text[places]
    order = np.argsort(symbol, kind="stable")
    places, symbol = places[order], symbol[order]
    cuts = np.flatnonzero(np.diff(symbol)) + 1
    for part, s in zip(np.split(places, cuts), symbol[np.r_[0, cuts]].tolist(), strict=True):
        queues[s].append(part)


def _induce(text: np.ndarray, small: np.ndarray, seeds: list[np.ndarray], symbols: int) -> np.ndarray:
    """All suffixes in order, from LMS suffixes in order by their first symbol (``seeds``)."""
    none = np.empty(0, text.dtype)
    queues: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    large = [none] * symbols
    for s in range(symbols):
        rounds, now = [], np.concatenate([none, *queues[s]])
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            same = text[before] == s
            _spread(before[~same], text, queues)
            now = before[same]
        large[s] = np.concatenate([none, *rounds])
        before = seeds[s][seeds[s] > 0] - 1
        _spread(before[~small[before]], text, queues)
    queues = [[] for _ in range(symbols)]
    out = [none] * symbols
    for s in range(symbols - 1, -1, -1):
        rounds, now = [], np.concatenate([none, *queues[s]])
        while len(now):
            rounds.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            same = text[before] == s
            _spread(before[~same], text, queues)
            now = before[same]
        if s == 0:
            rounds = [seeds[0]]  # the closing symbol
            before = seeds[0] - 1
            _spread(before[(before >= 0) & small[before]], text, queues)
        back = large[s][::-1]
        before = back[back > 0] - 1
        _spread(before[small[before]], text, queues)
        out[s] = np.concatenate([large[s], np.concatenate([none, *rounds])[::-1]])
    return np.concatenate(out)


def _by_symbol(places: np.ndarray, text: np.ndarray, symbols: int) -> list[np.ndarray]:
    queues: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _spread(places, text, queues)
    return [q[0] if q else places[:0] for q in queues]


def _names(text: np.ndarray, ordered: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of LMS substrings in their order: equal substrings share one. ``length`` goes by place."""
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    left, k = np.flatnonzero(same), 0
    while len(left):
        equal = text[a[left] + k] == text[b[left] + k]
        same[left[~equal]] = False
        k += 1
        left = left[equal & (length[a[left]] > k)]
    return np.append(0, np.cumsum(~same))


def suffix_array(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Places of all suffixes of ``text``, whose last symbol is the unique 0, ordered to ``depth`` symbols."""
    text = text.astype(np.int32)
    if len(text) == 1:
        return np.zeros(1, np.int32)
    small = _is_small(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    first = _induce(text, small, _by_symbol(lms, text, symbols), symbols)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    length = np.zeros(len(text), np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    rank_at = np.zeros(len(text), np.int64)
    rank_at[ordered] = _names(text, ordered, length)
    rank, width = rank_at[lms], 1
    while width * 2 <= depth + 1 and rank.max() + 1 < len(rank):  # a name spans two symbols at least
        later = np.append(rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64))[: len(rank)]
        _, rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)
        width *= 2
    return _induce(text, small, _by_symbol(lms[np.argsort(rank, kind="stable")], text, symbols), symbols)


def common_prefixes(body: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """By place: whether a suffix shares ``least`` bytes with the one before it in order (permuted form).

    ``body``: bytes, followed by at least ``least`` more than any place in ``order`` needs.
    """
    at, before = order[1:], order[:-1]
    words = np.ndarray((len(body) - 7,), "<u8", body.tobytes(), strides=(1,))
    alive = np.arange(len(at))
    for k in [*range(0, least - 7, 8), least - 8]:
        alive = alive[words[at[alive] + k] == words[before[alive] + k]]
    out = np.zeros(len(body), bool)
    out[at[alive]] = True
    return out
