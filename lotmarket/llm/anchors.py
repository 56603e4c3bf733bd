"""Anchors of long common strings: winnowed k-gram hashes, found for a step of texts at once."""

from __future__ import annotations

import numpy as np

from lotmarket.llm.common import mix64
from lotmarket.llm.shingles import BYTE_VALUES, place_powers

#: Length of the strings that must not come twice, and of the k-gram that anchors them.
LENGTH = 400
GRAM = 128
#: An anchor lies at most so many bytes after the start of a string that it anchors.
REACH = LENGTH - GRAM
_PLACE_BITS = 22
_PIECE = (1 << _PLACE_BITS) - LENGTH


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Polynomial sums of the bytes before each place, one more than bytes."""
    up, _ = place_powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[raw] * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each byte span; equal spans have equal hashes wherever they are."""
    _, down = place_powers(len(sums))
    return mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def find(raw: np.ndarray, offsets: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash) of all anchors: ``first`` to ``last`` are the starts of the strings it anchors.

    Of the k-grams in a string of LENGTH bytes, that with the least hash (the last of equals) is its anchor: it depends
    on the string alone, so equal strings have equal anchors at equal places in them.  Strings lie within one text.
    """
    if len(raw) < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    at = np.arange(len(raw) - GRAM + 1)
    grams = span_hashes(sums, at, at + GRAM)
    starts = len(raw) - LENGTH + 1
    chosen = np.empty(starts, dtype=np.int64)
    for lo in range(0, starts, _PIECE):  # places fit into the low bits of a key
        hi = min(starts, lo + _PIECE)
        part = grams[lo:hi + REACH]
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        keyed = (part & ~mask) | (mask - np.arange(len(part), dtype=np.uint64))
        chosen[lo:hi] = (mask - (_window_min(keyed, REACH + 1) & mask)).astype(np.int64) + lo
    start = np.arange(starts)
    row = np.searchsorted(offsets, start, side="right") - 1
    start = start[start + LENGTH <= offsets[row + 1]]
    chosen = chosen[start]
    begins = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)])) if len(start) else np.empty(0, np.int64)
    ends = np.concatenate([begins[1:], [len(start)]])[:len(begins)] - 1
    places = chosen[begins]
    return places, start[begins], start[ends], grams[places]
