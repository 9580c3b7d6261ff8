"""Anchors: positions that equal strings agree on.

Every window of ``LENGTH`` bytes is represented by its smallest ``GRAM``-byte
string in a random order (the leftmost of those that tie). The choice depends on
the window's bytes alone, so equal windows have their anchors at the same
place. Windows of one anchor start side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from panelloom.llm.words import mix

LENGTH, GRAM = 50, 16
PART = 1 << 18
_U = np.uint64
_PLACE = _U((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(977).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = []


@dataclass
class Anchors:
    """``at``: where the gram starts; windows start from ``first`` to ``last``; ``text``: whose it is."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text: np.ndarray
    gram: np.ndarray


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, 2 * PART + 2 * LENGTH), base, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers[0], _powers[1]


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position on."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = _BYTE[data]
    values *= up[: len(data)]
    np.cumsum(values, out=sums[1:])
    out = sums[width:] - sums[:n]
    out *= down[:n]
    out ^= out >> _U(32)
    out *= _U(0xD6E8FEB86659FD93)
    out ^= out >> _U(32)
    return out


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` values from each position on."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def _part(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    grams = rolling(data, GRAM)
    width = LENGTH - GRAM + 1
    n = len(grams) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, np.zeros(0, np.uint64)
    # the place in the low bits: the smallest value tells where it stands, the leftmost of equal ones wins
    low = _lowest((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), width)
    # windows that would reach over the end of their text do not count
    ends = np.append(starts[1:], len(data))
    out = np.zeros(n + 1, np.int32)
    np.add.at(out, np.minimum(np.maximum(ends - LENGTH + 1, starts), n), 1)
    np.add.at(out, np.minimum(ends, n), -1)
    whole = np.cumsum(out[:n]) == 0
    changes = np.ones(n + 1, bool)
    changes[1:n] = (low[1:] != low[:-1]) | (whole[1:] != whole[:-1])
    edges = np.flatnonzero(changes)
    first, last = edges[:-1], edges[1:] - 1
    some = whole[first]
    first, last = first[some], last[some]
    at = (low[first] & _PLACE).astype(np.int64)
    # smallest values crowd at the low end; mixed again, they are spread evenly over buckets
    return at, first, last, np.searchsorted(starts, first, "right") - 1, mix(grams[at])


def find(data: np.ndarray, starts: np.ndarray) -> Anchors:
    """The anchors of many texts that lie one after another; ``starts`` has the end as its last value."""
    found, i, n = [], 0, len(starts) - 1
    while i < n:
        j = max(int(np.searchsorted(starts, starts[i] + PART, "right")) - 1, i + 1)
        j = min(j, n)
        lo, hi = int(starts[i]), int(starts[j])
        # a text longer than a part is gone through in overlapping parts; each keeps the windows that start in it
        step = lo
        while step < hi or (step == lo == hi):
            stop = min(step + 2 * PART, hi) if j == i + 1 else hi
            upto = min(stop + LENGTH - 1, hi)
            inner = starts[i:j] - step if j > i + 1 else np.zeros(1, np.int64)
            at, first, last, text, gram = _part(data[step:upto], np.maximum(inner, 0))
            found.append((at + step, first + step, last + step, text + i, gram))
            step = stop
            if lo == hi:
                break
        i = j
    if not found:
        empty = np.zeros(0, np.int64)
        return Anchors(empty, empty, empty, empty, np.zeros(0, np.uint64))
    return Anchors(*(np.concatenate(x) for x in zip(*found)))
