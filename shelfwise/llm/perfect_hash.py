"""A minimal perfect hash over 128-bit keys, with fingerprints and counts beside it.

Keys fall into the slots of a level; a key alone in its slot is settled there, the others
go to the next, smaller level. The settled slots, counted in order, number the keys from 0
to n - 1. A bit per slot and a count per 64 slots are all that finding a number needs.
"""

from __future__ import annotations

import pickle

import numpy as np

_GAMMA = 1.6
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


def build(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> bytes:
    """Pack distinct keys (``first``, ``second``) and their counts.

    The place comes from both halves, the fingerprint is the second half.
    """
    keys = first ^ (second * _STEP)
    left, levels, before = np.arange(len(keys)), [], 0
    number = np.zeros(len(keys), np.int64)
    while len(left):
        size = max(64, int(len(left) * _GAMMA) + 64 & ~63)
        slot = _slot(keys[left], len(levels), size).astype(np.int64)
        alone = np.bincount(slot, minlength=size)[slot] == 1
        bits = np.zeros(size, np.uint8)
        bits[slot[alone]] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        ranks = before + np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]])
        number[left[alone]] = before + np.cumsum(bits, dtype=np.int64)[slot[alone]] - 1
        before += int(alone.sum())
        levels.append((size, words, ranks))
        left = left[~alone]
    prints, tally = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.int64)
    prints[number], tally[number] = second, counts
    narrow = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if not len(tally) or tally.max() <= np.iinfo(t).max)
    return pickle.dumps((levels, prints, tally.astype(narrow)))


def counts_of(packed: tuple, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Counts of the keys, 0 for those whose fingerprint is not at their place."""
    levels, prints, tally = packed
    out = np.zeros(len(first), np.int64)
    keys, left = first ^ (second * _STEP), np.arange(len(first))
    for level, (size, words, ranks) in enumerate(levels):
        slot = _slot(keys[left], level, size)
        place, bit = (slot >> np.uint64(6)).astype(np.int64), slot & np.uint64(63)
        word = words[place]
        there = (word >> bit) & np.uint64(1) == 1
        mask = (np.uint64(1) << bit[there]) - np.uint64(1)
        number = ranks[place[there]] + np.bitwise_count(word[there] & mask)
        found = left[there]
        same = prints[number] == second[found]
        out[found[same]] = tally[number[same]]
        left = left[~there]
        if not len(left):
            break
    return out
