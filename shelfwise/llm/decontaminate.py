"""Documents that repeat passages of a benchmark word for word.

Each task orders the words of its documents as suffix arrays, shard by shard, and looks
up every suffix of the benchmark by binary search, so no document word is shuffled. The
benchmark is the stated query set: it is read in blocks of bounded size, and a larger one
means more passes over the documents, never a larger broadcast.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import bounded
from shelfwise.llm.own_columns import keeping
from shelfwise.llm.suffixes import find, keys_of, spread, suffix_array
from shelfwise.llm.words import ALNUM, buffer_of, slabs, word_hashes
from shelfwise.workspace import discard, write_down

#: Words of one suffix array.
SHARD_WORDS = 1 << 20


class Windows(NamedTuple):
    """The windows of a block of items, each distinct one once."""

    names: list[str]
    words: np.ndarray
    item_of: np.ndarray
    start: np.ndarray
    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    depth: np.ndarray
    held_at: np.ndarray
    held_limits: np.ndarray


def windows_of(names: list[str], texts: list[str | None], size: int) -> Windows:
    """All ``size``-word windows; an item of fewer words, but not none, is one window."""
    data, offsets = buffer_of(pa.array(texts, pa.string()))
    words, limits = word_hashes(data, offsets, ALNUM)
    groups: dict[bytes, list[int]] = {}
    lengths = []
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        for at in range(a, max(b - size, a) + 1) if b > a else ():
            span = min(size, b - a)
            held = groups.setdefault(words[at : at + span].tobytes(), [])
            if not held:
                lengths.append(span)
            held.append(at)
    start = np.array([h[0] for h in groups.values()], np.int64)
    length = np.array(lengths, np.int64)
    codes = words >> np.uint64(48)
    low, high = np.zeros((len(start), 12), np.uint64), np.full((len(start), 12), 0xFFFF, np.uint64)
    for i in range(min(size, 12)):
        has = length > i
        low[has, i] = high[has, i] = codes[start[has] + i]
    join = lambda x: np.stack([x[:, j] << np.uint64(48) | x[:, j + 1] << np.uint64(32) | x[:, j + 2] << np.uint64(16) | x[:, j + 3] for j in (0, 4, 8)], 1)
    held = list(groups.values())
    limits_of = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int64)
    item_of = np.repeat(np.arange(len(names)), np.diff(limits))
    at = np.array([x for h in held for x in h], np.int64)
    return Windows(names, words, item_of, start, length, join(low), join(high), -(-length // 4), at, limits_of)


def occurrences(words: np.ndarray, doc_of: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``words`` where a window begins, and the window."""
    found_at, found = [], []
    for a in range(0, len(words), SHARD_WORDS):
        n = min(SHARD_WORDS, len(words) - a)
        part = words[a : a + n + 64]
        keys = keys_of(part)
        order = suffix_array(keys, n)
        begin, end = find(keys, order, w.low, w.high, w.depth)
        some = np.flatnonzero(end > begin)
        places, owner = spread(begin[some], end[some])
        places, owner = order[places] + a, some[owner]
        fits = places + w.length[owner] <= len(words)
        places, owner = places[fits], owner[fits]
        # The array is ordered by parts of the hashes: compare whole ones, inside one document.
        right = doc_of[places] == doc_of[places + w.length[owner] - 1]
        for i in range(int(w.length.max(initial=0))):
            check = right & (w.length[owner] > i)
            right[check] = words[places[check] + i] == w.words[w.start[owner[check]] + i]
        found_at.append(places[right])
        found.append(owner[right])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_at or empty), np.concatenate(found or empty)


def longest(doc_of: np.ndarray, places: np.ndarray, found: np.ndarray, w: Windows) -> dict[int, tuple[int, int, int]]:
    """By document: words of its longest verbatim match, where it begins, and the item."""
    at, owner = spread(w.held_limits[found], w.held_limits[found + 1])
    item_at, place, span = w.held_at[at], places[owner], w.length[found[owner]]
    order = np.lexsort((place, item_at - place))
    item_at, place, span = item_at[order], place[order], span[order]
    fresh = np.ones(len(place), bool)
    item, doc = w.item_of[item_at], doc_of[place]
    fresh[1:] = (np.diff(place) != 1) | (np.diff(item_at) != 1) | (np.diff(item) != 0) | (np.diff(doc) != 0)
    first = np.flatnonzero(fresh)
    words = np.diff(np.append(first, len(place))) - 1 + span[first]
    best: dict[int, tuple[int, int, int]] = {}
    for d, n, p, i in zip(doc_of[place[first]].tolist(), words.tolist(), place[first].tolist(), w.item_of[item_at[first]].tolist(), strict=True):
        if d not in best or (-n, p, i) < (-best[d][0], best[d][1], best[d][2]):
            best[d] = (n, p, i)
    return best


def _searcher(block, at: int, schema_names: list[str], again: bool):
    def search(batches):
        w = block.value
        for batch in batches:
            data, offsets = buffer_of(batch.column(at))
            rows = len(offsets) - 1
            old = dict(zip(batch.schema.names, batch.columns, strict=True))
            n_words, bits, items, length, where, which = [], [], [], [], [], []
            for a, b in slabs(offsets):
                words, limits = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM)
                doc_of = np.repeat(np.arange(b - a), np.diff(limits))
                places, found = occurrences(words, doc_of, w)
                edge = np.bincount(places, minlength=len(words) + 1) - np.bincount(places + w.length[found], minlength=len(words) + 1)
                hit = np.cumsum(edge[: len(words)]) > 0
                pairs = np.unique(doc_of[places] * np.int64(len(w.start) + 1) + found)
                at_, owner = spread(w.held_limits[pairs % (len(w.start) + 1)], w.held_limits[pairs % (len(w.start) + 1) + 1])
                named: dict[int, set[str]] = {}
                for d, i in zip((pairs // (len(w.start) + 1))[owner].tolist(), w.item_of[w.held_at[at_]].tolist(), strict=True):
                    named.setdefault(d, set()).add(w.names[i])
                best = longest(doc_of, places, found, w)
                for d in range(b - a):
                    mine = hit[limits[d] : limits[d + 1]]
                    n_words.append(len(mine))
                    bits.append(np.packbits(mine).tobytes() if d in named else b"")
                    items.append(sorted(named.get(d, ())))
                    n, p, i = best.get(d, (0, -1, -1))
                    length.append(n)
                    where.append(p - int(limits[d]) if n else None)
                    which.append(w.names[i] if n else None)
            if again:
                was = {c: old[c].to_pylist() for c in ("_bits", "items", "longest_words", "longest_at", "longest_item")}
                for r in range(rows):
                    if was["_bits"][r]:
                        both = np.frombuffer(was["_bits"][r], np.uint8)
                        bits[r] = (both | np.frombuffer(bits[r], np.uint8)).tobytes() if bits[r] else was["_bits"][r]
                        items[r] = sorted({*items[r], *was["items"][r]})
                        if (-was["longest_words"][r], was["longest_at"][r]) <= (-length[r], -1 if where[r] is None else where[r]):
                            length[r], where[r], which[r] = (was[c][r] for c in ("longest_words", "longest_at", "longest_item"))
            n_hit = [int(np.bitwise_count(np.frombuffer(x, np.uint8)).sum()) for x in bits]
            old |= {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "longest_words": pa.array(length, pa.int64()),
                "longest_at": pa.array(where, pa.int64()),
                "longest_item": pa.array(which, pa.string()),
                "contaminated": pa.array([x > 0 for x in n_hit], pa.bool_()),
                "_bits": pa.array(bits, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([old[c] for c in schema_names], schema_names)

    return search


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int):
    names, texts, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), text)
    for name, value in rows.toLocalIterator():
        if names and size + len(value or "") > block_chars:
            yield names, texts
            names, texts, size = [], [], 0
        names.append(name)
        texts.append(value)
        size += len(value or "")
    yield names, texts


_ADDED = "n_words long, n_hit long, items array<string>, longest_words long, longest_at long, longest_item string, contaminated boolean, _bits binary"

ADDED = tuple(column.split()[0] for column in _ADDED.split(", "))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, block_chars: int = 4_000_000,
) -> DataFrame:
    """``docs`` with what each shares with the items of ``benchmark``.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    lower-cased. A window is ``window`` (12 at most) consecutive item words; a shorter item
    with words is one window. Adds, in place of columns of these names: ``n_words``;
    ``n_hit``, the words inside any occurrence of a window; ``items``, the ids (as strings,
    sorted) of the items with an occurring window; ``longest_words, longest_at,
    longest_item``, the longest verbatim match, the word it begins at (from 0) and its item
    (ties: the earlier place), null where none; and ``contaminated``. A null or empty text
    or item has no words; a null item id counts as the empty string; repeated rows are
    judged alike; an empty benchmark hits nothing.
    """
    if "_bits" in docs.columns:  # the one column that only works here
        found = [c for c in docs.columns if c in ADDED and c != "_bits"]
        rest = docs.drop(*found)
        told = [c for c in ADDED if c != "_bits"]
        return keeping(rest, ["_bits"], lambda d: find_contamination(d, benchmark, text, item_id, item_text, window, block_chars), told)
    added = T.StructType.fromDDL(_ADDED)
    out, before, again = bounded(docs).drop(*added.names), None, False
    schema = T.StructType([*out.schema.fields, *added.fields])
    at = out.columns.index(text)
    blocks = _blocks(benchmark, item_id, item_text, block_chars)
    block = next(blocks)
    while block:
        later = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(windows_of(*block, window))
        out = out.mapInArrow(_searcher(shared, at, schema.names, again), schema)
        if later:
            step = write_down(out, "decontamination")
            if before:
                discard(docs.sparkSession, before)
            out, before, again = step.table, step.path, True
        block = later
    return out.drop("_bits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns, whatever their names."""
    if text in ADDED:  # the text under another name, for the columns that are added
        renamed = docs.withColumnRenamed(text, "_text")
        return decontaminate(renamed, benchmark, "_text", **options).withColumnRenamed("_text", text)
    return keeping(docs, ADDED, lambda d: find_contamination(d, benchmark, text, **options).where(~F.col("contaminated")))
