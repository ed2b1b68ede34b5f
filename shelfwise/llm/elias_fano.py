"""Elias-Fano sequences, and an n-gram trie whose levels are such sequences.

A non-decreasing sequence keeps the low bits of its values packed and the high bits in
unary, about 2 + log2(range / length) bits a value. All parts lie in one byte string that
can be mapped from a file; queries work on many values at once.
"""

from __future__ import annotations

import mmap

import numpy as np

_ONE = np.uint64(1)


def _u(x) -> np.uint64:
    return np.uint64(x)


class EliasFano:
    """Parts: ``[length, low bits]``, packed low bits, unary high bits, ones before each 64-bit word."""

    def __init__(self, parts: list[np.ndarray]):
        head, self.low, self.high, self.ones = parts
        self.length, self.bits = int(head[0]), int(head[1])

    @staticmethod
    def parts(values: np.ndarray, top: int) -> list[np.ndarray]:
        """The parts for sorted uint64 ``values`` of at most ``top``."""
        n = len(values)
        bits = max(0, int(top).bit_length() - max(n, 1).bit_length())
        slots = n * bits
        low = np.zeros(slots // 64 + 2, np.uint64)
        if bits:
            part = values & _u((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * _u(bits)
            word, shift = (at >> _u(6)).astype(np.int64), at & _u(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + _u(bits) > _u(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_u(64) - shift[over]))
        place = (values >> _u(bits)).astype(np.int64) + np.arange(n)
        size = n + (int(top) >> bits) + 2
        marks = np.zeros((size // 64 + 1) * 64, np.uint8)
        marks[place] = 1
        high = np.packbits(marks, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))]).astype(np.int64)
        return [np.array([n, bits], np.int64), low, high, ones]

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _u(self.bits)
        word, shift = (at >> _u(6)).astype(np.int64), at & _u(63)
        second = np.where(shift > 0, self.low[word + 1] << ((_u(64) - shift) & _u(63)), _u(0))
        return ((self.low[word] >> shift) | second) & _u((1 << self.bits) - 1)

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the bit of that rank (from 0) among the ones or the zeros of the high part."""
        before = self.ones if ones else np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(before, rank, "right") - 1
        bits = self.high[word] if ones else ~self.high[word]
        left, place = rank - before[word], np.zeros(len(rank), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & _u((1 << step) - 1)).astype(np.int64)
            over = left >= count
            left = np.where(over, left - count, left)
            place += np.where(over, step, 0)
            bits = np.where(over, bits >> _u(step), bits)
        return word * 64 + place

    def values(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        i = np.asarray(i, np.int64)
        return ((self._select(i, True) - i).astype(np.uint64) << _u(self.bits)) | self.low_bits(i)

    def successor(self, keys: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place in [begin, end) whose value is at least the key (``end`` if none), and whether it is the key."""
        high = (keys >> _u(self.bits)).astype(np.int64)
        low = keys & _u((1 << self.bits) - 1)
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - high + 1, 0)
        after = np.minimum(self._select(high, False) - high, end)
        lo = np.maximum(first, begin)
        hi = np.maximum(after, lo)
        while len(open_ := np.flatnonzero(lo < hi)):
            middle = (lo[open_] + hi[open_]) // 2
            up = self.low_bits(middle) < low[open_]
            lo[open_] = np.where(up, middle + 1, lo[open_])
            hi[open_] = np.where(up, hi[open_], middle)
        same = lo < after
        same[same] = self.low_bits(lo[same]) == low[same]
        return np.minimum(lo, end), same


def pack(parts: list[np.ndarray]) -> bytes:
    """Arrays as one byte string: a table of kinds and lengths, then the arrays, each at a multiple of 8 bytes."""
    kinds = {np.dtype(t): i for i, t in enumerate((np.uint64, np.int64, np.uint16, np.float64))}
    head = np.array([len(parts)] + [x for p in parts for x in (kinds[p.dtype], len(p))], np.int64)
    return b"".join([head.tobytes(), *(p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)])


def unpack(data) -> list[np.ndarray]:
    """Views of the arrays in ``data``, a byte string or a mapped file; nothing is copied."""
    kinds = (np.uint64, np.int64, np.uint16, np.float64)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for kind, length in head.tolist():
        out.append(np.frombuffer(data, kinds[kind], length, at))
        at += length * np.dtype(kinds[kind]).itemsize
        at += -at % 8
    return out


class NgramTrie:
    """Two levels: words, and under each word the contexts it was seen in.

    A context is kept relative to its word: word number * 2**40 + 40 bits of the context's
    hash, so a level is one non-decreasing sequence, pointers tell the range of each word,
    and a context is found by successor search inside that range. Every context has a
    smoothed log10 gain in 16 bits.
    """

    CONTEXT_BITS = 40

    def __init__(self, data):
        parts = unpack(data)
        self.words, self.pointers, self.contexts = (EliasFano(parts[i : i + 4]) for i in (0, 4, 8))
        self.gains, self.step = parts[12], float(parts[13][0])

    @classmethod
    def open(cls, path: str) -> "NgramTrie":
        """The trie in a file, mapped into memory."""
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @classmethod
    def build(cls, words: np.ndarray, starts: np.ndarray, contexts: np.ndarray, gains: np.ndarray) -> bytes:
        """From sorted word hashes, the start of each word's contexts (one more at the end), contexts sorted by word, and gains."""
        step = max(float(gains.max(initial=0.0)), 1e-9) / 65535
        relative = np.repeat(np.arange(len(words), dtype=np.uint64), np.diff(starts)) << _u(cls.CONTEXT_BITS) | contexts
        return pack(
            EliasFano.parts(words, (1 << 64) - 1)
            + EliasFano.parts(starts.astype(np.uint64), int(starts[-1]))
            + EliasFano.parts(relative, max(len(words), 1) << cls.CONTEXT_BITS)
            + [np.rint(gains / step).astype(np.uint16), np.array([step])]
        )

    def gain(self, words: np.ndarray, of: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Gain of each context of the word ``words[of]``, 0 where it was not seen."""
        out = np.zeros(len(of))
        if not self.words.length or not self.contexts.length:
            return out
        number, known = self.words.successor(words, np.zeros(len(words), np.int64), np.full(len(words), self.words.length))
        number = np.where(known, number, 0)
        begin, end = (self.pointers.values(number + i).astype(np.int64) for i in (0, 1))
        rows = np.flatnonzero(known[of])
        of = of[rows]
        key = number[of].astype(np.uint64) << _u(self.CONTEXT_BITS) | contexts[rows]
        at, seen = self.contexts.successor(key, begin[of], end[of])
        out[rows[seen]] = self.gains[at[seen]] * self.step
        return out
