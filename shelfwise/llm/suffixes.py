"""Suffix arrays over word hashes, ordered by their first twelve words, and their search."""

from __future__ import annotations

import numpy as np

DEPTH = 12


def keys_of(words: np.ndarray) -> np.ndarray:
    """One key per place: the leading 16 bits of four words; four places of padding follow."""
    codes = np.concatenate([words >> np.uint64(48), np.zeros(DEPTH, np.uint64)])
    n = len(words) + DEPTH - 4
    return codes[:n] << np.uint64(48) | codes[1 : n + 1] << np.uint64(32) | codes[2 : n + 2] << np.uint64(16) | codes[3 : n + 3]


def suffix_array(keys: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` places in the order of the twelve words that begin there."""
    order = np.argsort(keys[:n])
    first = keys[order]
    tied = np.zeros(n, bool)
    same = first[1:] == first[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    places = np.flatnonzero(tied)
    if len(places):
        part = order[places]
        order[places] = part[np.lexsort((keys[part + 8], keys[part + 4], first[places]))]
    return order


def find(keys: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray):
    """Range of ``order`` whose keys lie between ``low`` and ``high`` of each query.

    ``low`` and ``high`` hold three keys a query, ``depth`` how many of them count.
    """
    first = keys[order]
    begin, end = np.searchsorted(first, low[:, 0], "left"), np.searchsorted(first, high[:, 0], "right")
    for level in (1, 2):
        rows = np.flatnonzero((begin < end) & (depth > level))
        for right, target in ((False, low[:, level]), (True, high[:, level])):
            lo, hi = begin[rows].copy(), end[rows].copy()
            while len(open_ := np.flatnonzero(lo < hi)):
                middle = (lo[open_] + hi[open_]) // 2
                value, aim = keys[order[middle] + 4 * level], target[rows[open_]]
                up = value <= aim if right else value < aim
                lo[open_] = np.where(up, middle + 1, lo[open_])
                hi[open_] = np.where(up, hi[open_], middle)
            if right:
                end[rows] = lo
            else:
                fresh = lo
        begin[rows] = fresh if len(rows) else begin[rows]
    return begin, end


def spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and the range that each belongs to."""
    sizes = end - begin
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes), owner
