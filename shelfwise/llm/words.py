"""Words of many texts at once, as 64-bit hashes, with array operations only.

A batch of texts is one byte buffer with offsets, as Arrow holds it. A word is a maximal
run of word bytes inside one text. Its hash is a polynomial over random 64-bit values of
its bytes, modulo 2**64, so all words of a piece come from one cumulative sum. A to Z
count as a to z. Work is done in pieces of a few MB, cut between words, so that a very
long text needs no more memory than many short ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_SEED = np.random.default_rng(20240607)
_ODD = int(_SEED.integers(1 << 62, 1 << 63)) | 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def _value_table() -> np.ndarray:
    table = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    table[65:91] = table[97:123]
    return table


VALUES = _value_table()
#: White space of the word rule [^\x20\x09-\x0D]+.
SPACES = np.ones(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = False
#: Letters, digits and every byte beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow text column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if ends else np.zeros(1, np.int64)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    first = int(offsets[0])
    whole = np.frombuffer(data, np.uint8)[first : int(offsets[-1])] if data else np.zeros(0, np.uint8)
    return whole, offsets - first


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the row limits inside them (rows + 1 entries)."""
    hashes, starts_at = [], []
    begin, size = 0, len(data)
    up = down = np.zeros(0, np.uint64)
    while begin < size:
        end = min(size, begin + PIECE)
        if end < size:
            end = _cut(data, offsets, word_bytes, begin, end)
        piece = data[begin:end]
        n = len(piece)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = np.take(word_bytes, piece)
        cut = np.zeros(n + 1, bool)
        cut[offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end, "right")] - begin] = True
        first = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        last = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        if len(first):
            if len(up) < n + 1:
                up, down = _powers(_ODD, max(n, PIECE) + 1), _powers(_INVERSE, max(n, PIECE) + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(np.take(VALUES, piece) * up[:n], out=sums[1:])
            hashes.append((sums[last] - sums[first]) * down[first])
            starts_at.append(first + begin)
        begin = end
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    places = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
    return _mixed(words), np.searchsorted(places, offsets)


def _cut(data, offsets, word_bytes, begin: int, end: int) -> int:
    """A place near ``end`` that no word crosses."""
    back = np.flatnonzero(~word_bytes[data[max(begin, end - 4096) : end]])
    if len(back):
        return max(begin, end - 4096) + int(back[-1]) + 1
    edge = offsets[np.searchsorted(offsets, end) - 1]
    if edge > begin:
        return int(edge)
    while end < len(data) and word_bytes[data[end]] and end not in offsets[np.searchsorted(offsets, end) : np.searchsorted(offsets, end) + 1]:
        ahead = np.flatnonzero(~word_bytes[data[end : end + 65536]])
        limit = int(offsets[np.searchsorted(offsets, end)])
        end = min(limit, end + (int(ahead[0]) if len(ahead) else 65536), len(data))
    return end


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word; 0 is kept for no word."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return np.maximum(x, np.uint64(1))


def slabs(offsets: np.ndarray, size: int = 1 << 23):
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto
        row = upto


def shingle_hashes(words: np.ndarray, limits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of ``n``-word shingles by row, and the row limits inside them.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    rows = len(limits) - 1
    counts = np.diff(limits)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    factors = _powers(0x9E3779B97F4A7C15, n)
    out = np.zeros(int(starts[-1]), np.uint64)
    if len(words) >= n:
        rolled = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            rolled += words[i : len(words) - n + 1 + i] * factors[n - 1 - i]
        row_of = np.repeat(np.arange(rows), counts)
        whole = row_of[: len(words) - n + 1] == row_of[n - 1 :]
        out[np.repeat(counts >= n, sizes)] = rolled[whole] + np.uint64(n)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        each = np.zeros(len(short), np.uint64)
        for i in range(n - 1):
            has = counts[short] > i
            each[has] = each[has] * factors[1] + words[limits[short[has]] + i]
        out[starts[short]] = each + counts[short].astype(np.uint64)
    out = _mixed(out)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[starts[:-1][sizes > 0]] = True
    return out[fresh], np.concatenate([[0], np.cumsum(fresh)])[starts]
