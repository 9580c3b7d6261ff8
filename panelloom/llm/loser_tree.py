"""Sorted runs of strings, front-coded, and their merge by a tree of losers.

A front-coded run stores for each string how many first bytes it shares with
the string before, and the rest. The merge keeps for every run's next string
how many bytes it shares with the last string put out, and uses these numbers
first: bytes known to be equal are never compared again.
"""

from __future__ import annotations

import numpy as np

Run = tuple[list[bytes], list[int]]


def shared_prefixes(matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Equal first bytes of each row and the row before; rows are padded strings."""
    if not len(matrix):
        return np.zeros(0, np.int64)
    out = np.zeros(len(matrix), np.int64)
    differ = matrix[1:] != matrix[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def front_code(matrix: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Shared lengths, rest lengths and rests of sorted strings (rows of ``matrix``)."""
    known = shared_prefixes(matrix, lengths)
    place = np.arange(matrix.shape[1])
    rest = matrix[(place >= known[:, None]) & (place < lengths[:, None])]
    return known.astype(np.uint8).tobytes(), (lengths - known).astype(np.uint8).tobytes(), rest.tobytes()


def decode(known: bytes, more: bytes, rests: bytes) -> Run:
    """Inverse of ``front_code``."""
    strings, last, at = [], b"", 0
    for k, m in zip(known, more):
        last = last[:k] + rests[at : at + m]
        at += m
        strings.append(last)
    return strings, list(known)


def merge(runs: list[Run]) -> tuple[list[int], list[int]]:
    """Which run each string of the merged order comes from, and its bytes shared with the one before."""
    runs_n = len(runs)
    if runs_n == 1:
        return [0] * len(runs[0][0]), list(runs[0][1])
    size = 1
    while size < runs_n:
        size *= 2
    strings = [r[0] for r in runs] + [[]] * (size - runs_n)
    known = [r[1] for r in runs] + [[]] * (size - runs_n)
    place = [0] * size
    head = [s[0] if s else b"" for s in strings]
    same = [0 if s else -1 for s in strings]  # bytes shared with the last string put out; -1: the run has ended
    losers = [0] * size

    def play(node: int) -> int:
        if node >= size:
            return node - size
        a, b = play(2 * node), play(2 * node + 1)
        if same[a] < 0 or same[b] < 0:
            a, b = (b, a) if same[a] < 0 else (a, b)
        else:
            x, y = head[a], head[b]
            if y < x:
                a, b, x, y = b, a, y, x
            # b loses to a now, so what it shares with a is what counts from here on
            same[b] = _common(x, y, 0)
        losers[node] = b
        return a

    winner = play(1)
    same[winner] = min(same[winner], 0)
    from_run, shared = [], []
    add_run, add_shared = from_run.append, shared.append
    while same[winner] >= 0:
        add_run(winner)
        add_shared(same[winner])
        place[winner] = at = place[winner] + 1
        if at < len(strings[winner]):
            head[winner] = strings[winner][at]
            same[winner] = known[winner][at]
        else:
            same[winner] = -1
        node = (winner + size) >> 1
        h = same[winner]
        while node:
            other = losers[node]
            g = same[other]
            if g > h:
                losers[node] = winner
                winner, h = other, g
            elif g == h and h >= 0:
                x, y = head[winner], head[other]
                if x != y:
                    if y < x:
                        losers[node] = winner
                        same[winner] = _common(x, y, h)
                        winner = other
                    else:
                        same[other] = _common(x, y, h)
                else:
                    same[other] = len(x)
            node >>= 1
    return from_run, shared


def _common(x: bytes, y: bytes, at: int) -> int:
    n = min(len(x), len(y))
    while at + 8 <= n and x[at : at + 8] == y[at : at + 8]:
        at += 8
    while at < n and x[at] == y[at]:
        at += 1
    return at
