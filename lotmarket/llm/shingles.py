"""Hashes of word shingles for a step of texts at once, as numpy arrays.

Words are hashed from prefix sums of a polynomial over the bytes, so that no loop runs per word; shingles combine the
mixed hashes of their words.  All hashes have 64 bits and depend on nothing but the words.
"""

from __future__ import annotations

import numpy as np

from lotmarket.llm.common import mix64, powers

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: White space and all ASCII punctuation: separators where case and punctuation shall not count.
_PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLES = {"up": powers(_BASE, 1 << 10), "down": powers(_INVERSE, 1 << 10)}


def place_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES["up"]) < n:
        size = max(n, 2 * len(_TABLES["up"]))
        _TABLES["up"], _TABLES["down"] = powers(_BASE, size), powers(_INVERSE, size)
    return _TABLES["up"][:n], _TABLES["down"][:n]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: hash, row, and place of its first byte; per row: see ``offsets`` (as in ``text_bytes``).

    A-Z are lower-cased.  Words are runs without ASCII white space, or with ``plain`` without any ASCII character that
    is no letter or digit.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    gap = (_PLAIN if plain else _SPACE)[raw]
    begins = ~gap
    begins[1:] &= gap[:-1]
    rows = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[rows] = ~gap[rows]
    ends = ~gap
    ends[:-1] &= gap[1:]
    ends[rows[1:] - 1] = ~gap[rows[1:] - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = place_powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[_LOWER[raw]] * up, out=sums[1:])
    hashes = mix64((sums[last + 1] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(offsets, first, side="right") - 1, first


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per shingle: hash, row, and index of its first word.

    A row with fewer than ``size`` words, but one at least, has one shingle of all of them.
    """
    factor = mix64(np.arange(101, 101 + size, dtype=np.uint64))
    factor |= np.uint64(1)
    n = len(words)
    full = max(0, n - size + 1)
    total = np.zeros(full, dtype=np.uint64)
    for k in range(size):
        total += words[k:k + full] * factor[k]
    at = np.flatnonzero(rows[:full] == rows[size - 1:]) if full else np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if n else np.empty(0, np.int64)
    lengths = np.diff(np.concatenate([starts, [n]]))
    short, few = starts[lengths < size], lengths[lengths < size]
    sums = few.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(size - 1):
        has = few > k
        sums[has] += words[short[has] + k] * factor[k]
    hashes = mix64(np.concatenate([total[at], sums]))
    places = np.concatenate([at, short])
    return hashes, rows[places], places
