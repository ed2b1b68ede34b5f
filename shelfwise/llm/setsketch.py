"""SetSketch registers of many sets, and the similarity of two sets from their registers.

A register holds the smallest of exponential values drawn for the elements, on a scale of
powers of ``BASE``, cut off at both ends. Registers of a union are the maxima of the two
sets' registers. Two sets agree in a register with about the probability of their Jaccard
similarity, and which of two registers is larger tells the rest of the likelihood.
"""

from __future__ import annotations

import numpy as np

BASE = 1.001
RATE = 20.0
TOP = 65534
REGISTERS = 252


def register_keys(m: int = REGISTERS) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(77)
    return random.integers(1, 1 << 63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, m, dtype=np.uint64)


def sketch(elements: np.ndarray, limits: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Registers (rows x m, uint16) of the sets that lie between ``limits``; 0 for empty sets."""
    factors, offsets = register_keys(m)
    some = np.flatnonzero(np.diff(limits))
    out = np.zeros((len(limits) - 1, m), np.uint16)
    if not len(some):
        return out
    begin = limits[some]
    drawn, least = np.empty(len(elements), np.uint64), np.empty((m, len(some)), np.uint64)
    for i in range(m):
        np.multiply(elements, factors[i], out=drawn)
        np.add(drawn, offsets[i], out=drawn)
        least[i] = np.minimum.reduceat(drawn, begin)
    uniform = np.minimum((least.astype(np.float64) + 0.5) * 2.0**-64, 1 - 2.0**-53)
    value = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    out[some] = np.clip(value, 0, TOP + 1).astype(np.uint16).T
    return out


def band_shape(similarity: float, m: int = REGISTERS, missed: float = 1e-8) -> tuple[int, int]:
    """Bands and registers a band: the longest bands that miss a pair of this similarity with at most the given probability."""
    for rows in range(12, 0, -1):
        if (1 - similarity**rows) ** (m // rows) <= missed:
            return m // rows, rows
    return m, 1


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key (int64) per set and band; the band's number is part of it."""
    part = registers[:, : bands * rows].reshape(len(registers), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), part.shape[:2]).copy()
    for i in range(rows):
        key = (key ^ part[:, :, i]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _log_p(x: np.ndarray) -> np.ndarray:
    return -np.log(1 - np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def likelihoods(more: np.ndarray, less: np.ndarray, m: int, size_a: np.ndarray, size_b: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Log likelihood of each similarity (columns) for pairs (rows) with ``more`` and ``less`` larger registers in a."""
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    up, down = _log_p(u - v * similarity), _log_p(v - u * similarity)
    same = np.clip(1 - up - down, 1e-12, 1)
    return (
        more[:, None] * np.log(np.clip(up, 1e-12, 1)) + less[:, None] * np.log(np.clip(down, 1e-12, 1)) + (m - more - less)[:, None] * np.log(same)
    )


def may_reach(more, less, m: int, size_a, size_b, similarity: float, doubt: float = 44.0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose similarity may be ``similarity`` or more, and the likeliest similarity.

    A pair is ruled out when twice the log likelihood ratio against the threshold exceeds
    ``doubt`` (44: about 3 in 100,000,000,000 of pairs at the threshold).
    """
    size_a, size_b, more, less = (np.asarray(x, np.float64) for x in (size_a, size_b, more, less))
    grid = np.linspace(0.0, 1.0, 51)[None, :]
    grid = np.minimum(grid, (np.minimum(size_a, size_b) / np.maximum(size_a, size_b))[:, None])
    values = likelihoods(more, less, m, size_a, size_b, grid)
    best = values.argmax(1)
    likeliest = grid[np.arange(len(grid)), best]
    at = np.minimum(np.full((len(more), 1), similarity), grid[:, -1:])
    ratio = 2 * (values.max(1) - likelihoods(more, less, m, size_a, size_b, at)[:, 0])
    return (likeliest >= similarity) | (ratio <= doubt), likeliest
