"""Words and shingles of many texts at once, as 64-bit hashes over flat byte arrays.

A text is UTF-8 bytes; A-Z count as a-z; words are separated by the bytes
0x20 and 0x09-0x0D. A word's hash is a polynomial over random values of its
bytes, finished by a mixer, so a word hashes alike wherever it stands.
"""

from __future__ import annotations

import numpy as np

PART = 1 << 18  # bytes hashed at once; longer texts are hashed in parts cut between words
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_STEPS = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PART + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _hash_part(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    begin = np.flatnonzero(begins)
    last = inside[:-1] & (~inside[1:] | edge[1:])
    end = np.flatnonzero(last) + 1
    up, down = _tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    hashes = (sums[end] - sums[begin]) * down[begin]
    hashes = mix(hashes + (end - begin).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, begin, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of the text it stands in."""
    if len(data) <= PART:
        return _hash_part(data, starts[:-1]) if len(data) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    hashes, owners, at = [], [], 0
    while at < len(data):
        stop = min(at + PART, len(data))
        if stop < len(data):  # cut after the last separator or before the last text that starts here
            cuts = np.flatnonzero(_SPACE[data[at:stop]])
            stop_text = int(starts[np.searchsorted(starts, stop, "right") - 1])
            stop = max(at + int(cuts[-1]) + 1 if len(cuts) else 0, stop_text if stop_text > at else 0) or stop
            if stop <= at or (not len(cuts) and stop_text <= at):  # one word longer than a part
                later = np.flatnonzero(_SPACE[data[at:]])
                next_text = starts[np.searchsorted(starts, at, "right") :]
                ends = [at + int(later[0]) + 1] if len(later) else []
                ends += [int(next_text[0])] if len(next_text) else []
                stop = min([*ends, len(data)])
        first = int(np.searchsorted(starts, at, "right")) - 1
        inner = starts[:-1][(starts[:-1] > at) & (starts[:-1] < stop)] - at
        h, owner = _hash_part(data[at:stop], np.concatenate([[0], inner]))
        owner_of = np.searchsorted(starts[:-1], np.concatenate([[0], inner]) + at, "right") - 1
        owner_of[0] = min(max(first, 0), len(starts) - 2)
        hashes.append(h)
        owners.append(owner_of[owner])
        at = stop
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``width``-word shingles of each text, sorted; text i has those from bounds[i] to bounds[i + 1].

    A text of fewer words has its whole sequence as one shingle, one without
    words has none.
    """
    n = len(starts) - 1
    words, owner = word_hashes(data, starts)
    count = np.bincount(owner, minlength=n)[:n] if len(owner) else np.zeros(n, np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    size = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(size)])
    if not len(words):
        return np.zeros(0, np.uint64), bounds
    out = np.zeros(bounds[-1], np.uint64)
    text = np.repeat(np.arange(n), size)
    at = first[text] + np.arange(len(out)) - bounds[text]
    full = count[text] >= width
    for k in range(width):
        here = np.minimum(at + k, len(words) - 1)
        use = full | (k < count[text])
        out += np.where(use, words[here] * _STEPS[k], _U(0))
    out = mix(out + np.where(full, _U(width), count[text].astype(np.uint64)) * _STEPS[32])
    keep = np.ones(len(out), bool)
    for i in np.flatnonzero(size > 1):
        out[bounds[i] : bounds[i + 1]].sort()
    keep[1:] = out[1:] != out[:-1]
    keep[bounds[:-1][size > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[bounds]
