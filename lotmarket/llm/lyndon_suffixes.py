"""Suffix array by linear grouping.

Suffixes are grouped by their longest Lyndon prefix.  Groups begin as the suffixes with one first symbol and are taken
from the last in order to the first.  Each suffix of the group at hand points to its *previous smaller* suffix, the
nearest one before it that lies in a lower group; it is found by following the pointers that are already there.  What
is pointed to has a longer Lyndon prefix than its group-mates, so it moves into a new group right above its own: those
that are pointed to most often highest.  When all groups are done their order is final, and one pass from the smallest
suffix on puts every suffix at its group's next free place: after the suffix at i is placed, the one at i - 1 is, and
then the chain of its previous smaller pointers.  No symbol is ever renamed and nothing recurs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in ascending order; the last symbol must be smaller than all others."""
    n = len(symbols)
    order, group, before = _groups(symbols)
    free = list(range(n))  # next free place of the group that starts there
    placed = bytearray(n)
    out = [n - 1] * n
    placed[n - 1] = 1
    free[0] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            s = before[s]
    return np.array(out, dtype=np.int64)


def _groups(symbols: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Suffixes in order of their groups, the start of each suffix's group, and its previous smaller suffix or -1."""
    n = len(symbols)
    by = np.argsort(symbols, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], symbols[by][1:] != symbols[by][:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    place = np.empty(n, dtype=np.int64)
    place[by] = np.arange(n)
    first = np.empty(n, dtype=np.int64)
    first[by] = np.repeat(starts, sizes)
    order, place, group = by.tolist(), place.tolist(), first.tolist()
    size = np.zeros(n, dtype=np.int64)
    size[starts] = sizes
    size = size.tolist()
    before = [-1] * n

    end = n
    while end:
        start = group[order[end - 1]]
        if end - start == 1:  # the usual case, without the tables below
            i = order[start]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            targets = [(p,)] if p >= 0 else []
        else:
            pointed: dict[int, int] = {}
            for i in sorted(order[start:end]):
                p = i - 1
                while p >= 0 and group[p] >= start:
                    p = before[p]
                before[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            gathered: dict[tuple[int, int], list[int]] = {}
            for p, times in pointed.items():
                gathered.setdefault((-times, group[p]), []).append(p)
            targets = [gathered[k] for k in sorted(gathered)]
        for move in targets:
            old = group[move[0]]
            left = size[old] - len(move)
            if not left:  # the whole group moves: it stays where it is
                continue
            new = last = old + left
            last += len(move)
            for p in move:  # to the end of what is left of the group
                last -= 1
                other, here = order[last], place[p]
                order[here], order[last] = other, p
                place[other], place[p] = here, last
            for p in move:
                group[p] = new
            size[old], size[new] = left, len(move)
        end = start
    return order, group, before
