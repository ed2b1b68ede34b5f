"""Passages that repeat across documents, by content-defined chunks and exact ends.

A rolling gear hash runs over the bytes; a chunk ends where it is smallest in some window of
``SPAN`` places and in its neighbourhood, so chunks (25 bytes on average) move with the
text when something is inserted before them. Digests of chunks are counted over all
documents; what several documents hold are neighbouring chunks that make up runs.

Ends are exact: for the first and last chunk of each run, all documents that hold this
chunk give the bytes around it. Sorted, a text's longest agreement with any other is
found in one pass with a stack, whichever documents hold the chunk and however many. Rows
are sorted over the cluster by range, so a chunk of any number of documents is spread over
blocks; between blocks passes one stack of at most as many entries as bytes are compared.

Only digests, places and the bytes around ends are shuffled, no text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded
from shelfwise.llm.words import buffer_of, slabs
from shelfwise.workspace import discard, write_down

#: Bytes that the gear hash sees, places of which the smallest hash ends a chunk, and places around an end that hold no other.
WINDOW, SPAN, CLOSE = 16, 32, 11
#: Code points of a passage that counts, and bytes of a run whose ends are looked for.
MIN_RUN, LEAST = 120, 28
#: Bytes beyond a chunk that are compared: behind them another whole chunk would be shared.
REACH = 128
#: Bytes of text that are cut at once; their arrays stay in a processor's cache.
PIECE = 1 << 18
#: Rows of a block of sorted ends, about, and bits of a filter (16 MB) as a power of two.
BLOCK_ROWS, FILTER_BITS = 200_000, 27
_RANDOM = np.random.default_rng(20240611)
GEAR = _RANDOM.integers(0, 1 << 32, 256, dtype=np.uint32)
VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = int(_RANDOM.integers(1 << 62, 1 << 63)) | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_MOST = np.uint32(0xFFFFFFFF)
#: Bytes inside a character.
_INSIDE = bytes(range(0x80, 0xC0))
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


_KNOWN: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers, remembered as far as they were ever asked for."""
    if base not in _KNOWN or len(_KNOWN[base]) < n:
        out = np.full(max(n, 2 * PIECE + 1), base, np.uint64)
        out[:1] = 1
        _KNOWN[base] = np.cumprod(out, dtype=np.uint64)
    return _KNOWN[base][:n]


def _slid(values: np.ndarray, take, span: int) -> np.ndarray:
    """``take`` (minimum or maximum) of every window of ``span`` values."""
    width = 1
    while width < span:
        more = min(width, span - width)
        values = take(values[:-more], values[more:])
        width += more
    return values


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places after which a chunk ends, the end of every row among them; those inside a row depend on the row alone."""
    n, rows = len(data), len(offsets) - 1
    limits = offsets[1:][np.diff(offsets) > 0]
    if n < SPAN:
        return limits
    hashed = GEAR[data]
    step = 1
    while step < WINDOW:
        shifted = np.zeros(n, np.uint32)
        shifted[step:] = hashed[:-step] << np.uint32(step)
        hashed = hashed + shifted
        step *= 2
    # The gear hash has its oldest bytes in the high bits only; spread them before comparing.
    mixed = hashed * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed = ((mixed * np.uint32(0x85EBCA77)) >> np.uint32(1)) + np.uint32(1)
    place = np.arange(n, dtype=np.int32)
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    # Not within the first or last bytes of a row, and not inside a character.
    barred = (place - offsets[:-1].astype(np.int32)[row] < WINDOW - 1) | (offsets[1:].astype(np.int32)[row] - place <= CLOSE)
    barred[:-1] |= (data[1:] & 0xC0) == 0x80
    mixed[barred] = _MOST
    # Rows are set apart by zeros: a window that crosses them has no smallest place.
    at = place + row * np.int32(SPAN) if rows > 1 else slice(0, n)
    apart = np.zeros(n + (rows - 1) * SPAN, np.uint32)
    apart[at] = mixed
    edge = np.zeros(SPAN - 1, np.uint32)
    # The smallest place of some window is no smaller than the greatest of its windows' smallest.
    most = _slid(np.concatenate([edge, _slid(apart, np.minimum, SPAN), edge]), np.maximum, SPAN)
    found = np.flatnonzero((mixed <= most[at]) & ~barred)
    # Of places close together the smallest stays, so that no chunk is tiny.
    apart[apart == 0] = _MOST
    edge = np.full(CLOSE, _MOST, np.uint32)
    near = _slid(np.concatenate([edge, apart, edge]), np.minimum, 2 * CLOSE + 1)
    ends = found[mixed[found] <= near[at][found]] + 1
    return np.union1d(ends, limits)


class Chunks:
    """Chunks of rows of a buffer: row, digest, places in bytes of the buffer and in code points of the row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ends: np.ndarray, base: int = 0, points: int = 0, row: int = 0):
        """``data`` lies at ``base`` of the buffer; its first row is the buffer's ``row``, ``points`` code points in."""
        n = len(data)
        end = ends.astype(np.int64)
        start = np.concatenate([[0], end[:-1]]) if len(end) else end
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(VALUES[data] * _powers(_ODD, n), out=sums[1:])
        digest = (sums[end] - sums[start]) * _powers(_INVERSE, n + 1)[start]
        digest ^= (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        digest ^= digest >> np.uint64(31)
        digest *= np.uint64(0xD6E8FEB86659FD93)
        self.digest = (digest ^ (digest >> np.uint64(32))).view(np.int64)
        own = np.searchsorted(offsets, start, "right") - 1
        seen = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.first, self.last = (seen[x] - seen[offsets[own]] + points for x in (start, end))
        self.row, self.start, self.end = own + row, start + base, end + base


def _long(data: np.ndarray, low: int, high: int, row: int):
    """The chunks of one long row, some MB at a time; ends are found as in the row as a whole."""
    around, points, first = SPAN + WINDOW, 0, low
    while low < high:
        upto = min(high, low + PIECE)
        begin, behind = max(first, low - around), min(high, upto + around)
        piece = data[begin:behind]
        ends = chunk_ends(piece, np.array([0, len(piece)])) + begin
        ends = ends[(ends > low) & (ends <= upto)]
        if not len(ends):
            raise AssertionError("a chunk of some MB")
        upto = int(ends[-1])
        found = Chunks(data[low:upto], np.array([0, upto - low]), ends - low, low, points, row)
        points = int(found.last[-1])
        yield found
        low = upto


def _pieces(batch: pa.RecordBatch, at: int):
    """The batch's texts as a buffer with row limits, and their chunks, some MB of texts at a time."""
    data, offsets = buffer_of(batch.column(at))
    for a, b in slabs(offsets, PIECE):
        low, high = int(offsets[a]), int(offsets[b])
        if high - low > 2 * PIECE:  # a single row
            for found in _long(data, low, high, a):
                yield data, offsets, found
        elif high > low:
            own = offsets[a : b + 1] - low
            yield data, offsets, Chunks(data[low:high], own, chunk_ends(data[low:high], own), low, 0, a)


def chunks(data: np.ndarray, offsets: np.ndarray):
    """Row, digest, first code point (from the row's start) and code points of every chunk."""
    if not len(data):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    found = Chunks(data, offsets, chunk_ends(data, offsets))
    return found.row, found.digest, found.first, found.last - found.first


def _may_be(filter_: np.ndarray, digests: np.ndarray) -> np.ndarray:
    spots = digests.view(np.uint64)
    out = np.ones(len(digests), bool)
    for shift in (0, 32):
        spot = (spots >> np.uint64(shift)) & np.uint64((len(filter_) << 6) - 1)
        out &= (filter_[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _filter(digests: DataFrame, bits: int) -> np.ndarray:
    """Bits of the digests in a filter of fixed size, which may therefore pass through the driver."""
    mask = (1 << bits) - 1
    spot = F.explode(F.array(F.col("digest").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("digest", 32).bitwiseAND(F.lit(mask))))
    cells = digests.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("cell"))
    value = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(F.lit(63)).cast("int")))
    found = cells.agg(value.alias("value")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["cell"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return out


def _digests(batches):
    """``digest, doc_id``, each pair once in a piece."""
    for batch in batches:
        for _, _, found in _pieces(batch, 1):
            ids = batch.column(0).take(pa.array(found.row))
            once = pa.table([pa.array(found.digest), ids], ["digest", "doc_id"]).group_by(["digest", "doc_id"]).aggregate([])
            yield from once.to_batches()


def _occurrences(shared):
    """The chunks whose digests pass the filter, with their places in bytes and code points."""

    def run(batches):
        filter_ = shared.value
        for batch in batches:
            for _, offsets, found in _pieces(batch, 2):
                at = np.flatnonzero(_may_be(filter_, found.digest))
                rows = found.row[at]
                begin = offsets[rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(found.digest[at]),
                        pa.array(found.start[at] - begin), pa.array(found.end[at] - begin), pa.array(found.first[at]), pa.array(found.last[at]),
                    ],
                    ["doc_id", "h", "digest", "start", "end", "first", "last"],
                )

    return run


def _ends(firsts, lasts, runs=None):
    """Bytes around the chunks that begin or end a run somewhere, from the chunk outward, the chunk included.

    White space is a blank there, and so is the end of a text (``closed``). Side 0 is read
    backwards. With ``runs``, a filter of the ends of runs, only they come.
    """

    def run(batches):
        filters = (firsts.value, lasts.value)
        for batch in batches:
            texts_of = batch.column(1).to_numpy()
            for data, offsets, found in _pieces(batch, 2):
                for side, filter_ in enumerate(filters):
                    at = np.flatnonzero(_may_be(filter_, found.digest))
                    if runs:
                        begin = found.start[at] - offsets[found.row[at]]
                        at = at[_may_be(runs.value, _end_keys(texts_of[found.row[at]], begin, side))]
                    for some in np.array_split(at, len(at) // 20_000 + 1):
                        rows = found.row[some]
                        low = np.maximum(found.start[some] - (0 if side else REACH), offsets[rows])
                        high = np.minimum(found.end[some] + (REACH if side else 0), offsets[rows + 1])
                        closed = (high == offsets[rows + 1]) if side else (low == offsets[rows])
                        texts = [data[x:y].tobytes().translate(_SPACES) for x, y in zip(low.tolist(), high.tolist())]
                        texts = [t if side else t[::-1] for t in texts]
                        texts = [t + b" " if c else t for t, c in zip(texts, closed.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([side] * len(some), pa.int32()), pa.array(found.digest[some]), pa.array(texts, pa.binary()),
                                batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                                pa.array(found.start[some] - offsets[rows]), pa.array((found.end - found.start)[some]), pa.array(closed),
                            ],
                            ["side", "digest", "bytes", "doc_id", "h", "start", "size", "closed"],
                        )

    return run


def _end_keys(h: np.ndarray, start: np.ndarray, side: int) -> np.ndarray:
    """A hash of text, place and side, for the filter of run ends."""
    x = (h.astype(np.int64).view(np.uint64) + start.astype(np.uint64) * np.uint64(2) + np.uint64(side)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _keyed_ends(batches):
    for batch in batches:
        h, first, last = (batch.column(i).to_numpy() for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_end_keys(h, first, 0), _end_keys(h, last, 1)]))], ["digest"])


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Stack:
    """Documents seen before a text in sorted order, by how many bytes they share with it.

    Entries ``[length, smallest id, greatest id]`` have rising lengths; an entry stands for
    the documents that share so many bytes, and no more.
    """

    def __init__(self, key=None, text: bytes = b"", entries=()):
        self.key, self.text, self.entries = key, text, [list(e) for e in entries]

    def move(self, key, text: bytes, common: int | None = None) -> None:
        """Go on to the next text; ``common`` says how many bytes it shares with the last one, if that is known."""
        if key != self.key:
            self.key, self.text, self.entries = key, text, []
            return
        if common is None:
            common = _agree(self.text, text)
        low = high = None
        while self.entries and self.entries[-1][0] >= common:
            _, a, z = self.entries.pop()
            low, high = (a, z) if low is None else (min(low, a), max(high, z))
        if low is not None:
            self.entries.append([common, low, high])
        self.text = text

    def add(self, low, high=None) -> None:
        """Note the document of the present text, or those of smallest and greatest id."""
        size, high = len(self.text), low if high is None else high
        if self.entries and self.entries[-1][0] == size:
            top = self.entries[-1]
            top[1], top[2] = min(top[1], low), max(top[2], high)
        else:
            self.entries.append([size, low, high])

    def longest(self, doc) -> tuple[int, int]:
        """Most bytes shared with another document, and with one of smaller id."""
        other = below = 0
        for length, low, high in reversed(self.entries):
            if not other and (low != doc or high != doc):
                other = length
            if low < doc:
                return other, length
        return other, below


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("place")


def _edges(table: pa.Table) -> pa.Table:
    """The stack behind a block in either direction, as if nothing came before. Only the texts of its last chunk matter."""
    table = _sorted(table)
    sides, digests = (table[c].to_numpy() for c in ("side", "digest"))
    texts, lows, highs = table["bytes"], table["low"], table["high"]
    out = []
    for end, step in ((len(sides) - 1, 1), (0, -1)):
        mine = np.flatnonzero((sides == sides[end]) & (digests == digests[end]))
        stack = Stack()
        for text, low, high in list(zip(*(c.take(pa.array(mine)).to_pylist() for c in (texts, lows, highs))))[::step]:
            stack.move("", text)
            stack.add(low, high)
        out.append((step > 0, sides[end], digests[end], stack.text, stack.entries))
    kind = table.schema.field("low").type
    n = len(out)
    return pa.table({
        "block": pa.array([table["block"][0].as_py()] * n, pa.int32()), "forward": pa.array([x[0] for x in out]),
        "first_key": pa.array([f"{sides[0]}:{digests[0]}"] * n), "last_key": pa.array([f"{sides[-1]}:{digests[-1]}"] * n),
        "bytes": pa.array([x[3] for x in out], pa.binary()),
        "lengths": pa.array([[e[0] for e in x[4]] for x in out], pa.list_(pa.int32())),
        "lows": pa.array([[e[1] for e in x[4]] for x in out], pa.list_(kind)), "highs": pa.array([[e[2] for e in x[4]] for x in out], pa.list_(kind)),
    })


def _carried(edges: list, forward: bool) -> dict[int, tuple]:
    """For each block the stack that its neighbour hands on, where both hold the same chunk at their seam."""
    out, before = {}, None
    for e in edges if forward else edges[::-1]:
        enters, leaves = (e["first_key"], e["last_key"]) if forward else (e["last_key"], e["first_key"])
        if before is not None and before.key == enters:
            out[e["block"]] = (before.key, before.text, [tuple(x) for x in before.entries])
        entries = list(zip(e["lengths"], e["lows"], e["highs"]))
        if before is not None and before.key == enters == leaves:
            # The whole block is one chunk: what came before it stays reachable.
            joined = Stack(before.key, before.text, before.entries)
            joined.move(leaves, e["bytes"])
            merged: dict = {}
            for length, low, high in [*joined.entries, *entries]:
                a, z = merged.get(length, (low, high))
                merged[length] = (min(a, low), max(z, high))
            entries = [(length, *merged[length]) for length in sorted(merged)]
        before = Stack(leaves, e["bytes"], entries)
    return out


def _cut(text: bytes, common: int, size: int) -> int:
    """Bytes beyond the chunk that agree, to whole words: the last one counts if white space follows in both."""
    if not common:
        return 0
    blank = text.rfind(b" ", 0, common)
    return (common if blank < 0 else blank + 1) - size


def _commons(texts: pa.Array) -> np.ndarray:
    """For each text how many bytes it shares with the one before; 0 for the first."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    lengths = pc.binary_length(texts).to_numpy()
    out = np.zeros(len(texts), np.int64)
    for begin in range(0, len(texts), 20_000):
        some = texts[max(0, begin - 1) : begin + 20_000]
        size = lengths[max(0, begin - 1) : begin + 20_000]
        rows = np.zeros((len(some), int(size.max(initial=0)) + 1), np.uint8)
        inside = np.arange(rows.shape[1]) < size[:, None]
        rows[inside] = np.frombuffer(b"".join(some.to_pylist()), np.uint8)
        differ = (rows[1:] != rows[:-1]) | ~inside[1:] | ~inside[:-1]
        out[max(1, begin) : begin + 20_000] = differ.argmax(axis=1)
    return out


def _grown(shared):
    """For each end: code points by which a run grows there (or shrinks).

    ``grown`` against any other document and ``grown_below`` against smaller ids, for the
    smallest id that has this end; ``grown_alike`` for all others, which agree with that one.
    Null where nothing agrees.
    """

    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        forward, backward = shared.value
        block = table["block"][0].as_py()
        commons = _commons(table["bytes"]).tolist()
        texts, lows, highs, sizes, closed = (table[c].to_pylist() for c in ("bytes", "low", "high", "size", "closed"))
        keys = list(zip(table["side"].to_pylist(), table["digest"].to_pylist()))
        n = len(texts)
        alike = list(map(len, texts))
        others, belows = [size if low != high else 0 for size, low, high in zip(alike, lows, highs)], [0] * n
        for way, carried in ((1, forward), (-1, backward)):
            stack, first = Stack(), 0 if way > 0 else n - 1
            if block in carried:
                key, text, entries = carried[block]
                side, _, digest = key.partition(":")
                stack = Stack((int(side), int(digest)), text, entries)
            for i in range(n) if way > 0 else range(n - 1, -1, -1):
                stack.move(keys[i], texts[i], None if i == first else commons[i] if way > 0 else commons[i + 1])
                other, below = stack.longest(lows[i])
                if other > others[i]:
                    others[i] = other
                if below > belows[i]:
                    belows[i] = below
                stack.add(lows[i], highs[i])
        grown = []
        for best in (others, belows, alike):
            values = []
            for common, size, text, at_end in zip(best, sizes, texts, closed):
                if common < size:  # a chunk that only looked shared
                    values.append(None)
                    continue
                more = _cut(text, common, size)
                # bytes that begin a character; the blank for the end of a text is none
                if more > 0:
                    values.append(len(text[size : size + more].translate(None, _INSIDE)) - (at_end and size + more == len(text)))
                else:
                    values.append(-len(text[size + more : size].translate(None, _INSIDE)))
            grown.append(pa.array(values, pa.int64()))
        return pa.table([table["digest"], table["around"], table["low"], *grown], ["digest", "around", "low", "grown", "grown_below", "grown_alike"])

    return run


def _runs(held: DataFrame) -> DataFrame:
    """Runs of neighbouring shared chunks of each text, of all chunks and (``removable``) of those that smaller ids hold."""
    order = Window.partitionBy("doc_id", "h").orderBy("start")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("first_doc") < F.col("doc_id")
    # Chunks of a text do not overlap; those of repeated rows lie on one another.
    marked = held.withColumns({
        "any_fresh": F.when(F.col("start") <= F.lag("end").over(order), 0).otherwise(1),
        "below_fresh": F.when(~below | (F.col("start") <= F.max(F.when(below, F.col("end"))).over(past)), 0).otherwise(1),
    })
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumns({"any_run": F.sum("any_fresh").over(upto), "below_run": F.sum("below_fresh").over(upto)})
    one = lambda flag, run: F.struct(F.lit(flag).alias("removable"), F.col(run).alias("run"))
    kinds = F.when(below, F.array(one(False, "any_run"), one(True, "below_run"))).otherwise(F.array(one(False, "any_run")))
    each = counted.withColumn("kind", F.explode(kinds)).select("*", "kind.removable", "kind.run")
    place = F.struct("start", "digest")
    runs = each.groupBy("doc_id", "h", "removable", "run").agg(
        F.min(place).alias("a"), F.max(place).alias("z"), F.max("end").alias("end"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("first_doc").alias("first_doc"),
    )
    long_ = runs.where(F.col("end") - F.col("a.start") >= LEAST)
    return long_.select(
        "doc_id", "h", "removable", "first", "last", "first_doc", F.col("a.start").alias("start"), F.col("a.digest").alias("first_digest"),
        F.col("z.start").alias("last_start"), F.col("z.digest").alias("last_digest"),
    )


def _grow(ends: DataFrame) -> DataFrame:
    """``digest, around, low, grown, grown_below, grown_alike`` for every end with the bytes around it, once however many documents have it."""
    spark = ends.sparkSession
    order = ["side", "digest", "bytes", "closed"]
    once = ends.groupBy(*order).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("size").alias("size"))
    once = write_down(once, "ends")
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), once.table.count() // BLOCK_ROWS + 1)
    laid = once.table.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
    laid = laid.select("*", _around().alias("around"), F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("place"))
    laid = write_down(laid, "sorted-ends")
    discard(spark, once.path)
    kind = laid.table.schema["low"].dataType.simpleString()
    schema = f"block int, forward boolean, first_key string, last_key string, bytes binary, lengths array<int>, lows array<{kind}>, highs array<{kind}>"
    # One stack a block and direction, of at most as many entries as bytes are compared.
    edges = sorted(laid.table.groupBy("block").applyInArrow(_edges, schema).collect(), key=lambda r: r["block"])
    carried = tuple(_carried([e for e in edges if e["forward"] == way], way) for way in (True, False))
    shared = spark.sparkContext.broadcast(carried)
    grown = laid.table.groupBy("block").applyInArrow(
        _grown(shared), f"digest long, around long, low {kind}, grown long, grown_below long, grown_alike long"
    )
    done = write_down(grown, "grown").table
    discard(spark, laid.path)
    return done


def _around():
    return F.xxhash64("side", "digest", "bytes", "closed")


def repeated_spans(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN, bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, h, removable, start, length, first_doc``: the passages of each text that other documents hold too.

    Places and lengths are code points. Runs of shared chunks are extended, to whole words, as
    far as any other document that holds the end chunk agrees (white space counts as alike
    there); what overlaps or touches is one passage, and counts from ``min_run`` code
    points on. ``first_doc`` is the smallest id that holds one of its chunks. Rows with
    ``removable`` true are the passages that documents of smaller id hold. ``h`` is
    xxhash64 of the text, which tells texts of one id apart; they are one document and do not
    repeat one another. Rows without id, null and empty texts have none; repeated rows
    have theirs once; an empty table gives an empty one.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    named = bounded(docs).select("doc_id", F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    named = named.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    found = named.select("doc_id", "text").mapInArrow(_digests, f"digest long, doc_id {kind}")
    # Ends of the range of ids: combined before the shuffle, however often a chunk occurs.
    counted = found.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last"))
    several, several_path = write_down(counted.where(F.col("first_doc") < F.col("last")).select("digest", "first_doc"), "several")
    filter_ = spark.sparkContext.broadcast(_filter(several, bits))
    places = named.mapInArrow(_occurrences(filter_), f"doc_id {kind}, h long, digest long, start long, end long, first long, last long")
    # Adaptive execution splits the chunks that very many documents hold.
    held = places.join(several, "digest")
    runs = write_down(_runs(held), "runs").table
    discard(spark, several_path)
    share = spark.sparkContext.broadcast
    sides = [share(_filter(runs.select(F.col(c).alias("digest")), bits)) for c in ("first_digest", "last_digest")]
    schema = f"side int, digest long, bytes binary, doc_id {kind}, h long, start long, size long, closed boolean"
    grown = _grow(named.mapInArrow(_ends(*sides), schema))
    own = share(_filter(runs.select("h", "start", "last_start").mapInArrow(_keyed_ends, "digest long"), bits))
    mine = named.mapInArrow(_ends(*sides, own), schema).select("doc_id", "h", "side", "start", "digest", _around().alias("around"))
    edges = F.inline(F.array(
        F.struct(F.lit(0).alias("side"), F.col("start").alias("at"), F.col("first_digest").alias("digest")),
        F.struct(F.lit(1).alias("side"), F.col("last_start").alias("at"), F.col("last_digest").alias("digest")),
    ))
    sought = runs.select("doc_id", "h", "removable", "first", "last", "first_doc", "start", edges).withColumnRenamed("start", "run")
    seen = mine.select(F.col("doc_id").alias("d"), F.col("h").alias("t"), F.col("side").alias("s"), F.col("start").alias("b"), "around")
    same = (F.col("doc_id") == F.col("d")) & (F.col("h") == F.col("t")) & (F.col("side") == F.col("s")) & (F.col("at") == F.col("b"))
    known = sought.join(seen, same, "left").drop("d", "t", "s", "b")
    told = known.join(grown, ["digest", "around"], "left")
    first = F.when(F.col("removable"), F.col("grown_below")).otherwise(F.col("grown"))
    more = F.coalesce(F.when(F.col("doc_id") == F.col("low"), first).otherwise(F.col("grown_alike")), F.lit(0))
    each = told.groupBy("doc_id", "h", "removable", "run").agg(
        F.min(F.when(F.col("side") == 0, F.col("first") - more)).alias("start"), F.max(F.when(F.col("side") == 1, F.col("last") + more)).alias("end"),
        F.min("first_doc").alias("first_doc"),
    ).drop("run")
    order = Window.partitionBy("doc_id", "h", "removable").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= before, 0).otherwise(1)
    numbered = each.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("doc_id", "h", "removable", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc").alias("first_doc"))
    long_ = spans.where(F.col("end") - F.col("start") >= min_run)
    return long_.select("doc_id", "h", "removable", "start", (F.col("end") - F.col("start")).alias("length"), "first_doc")


def _by_text(docs: DataFrame, text: str, min_run: int) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its ``spans`` and ``removed`` ones."""
    place = lambda flag: F.array_sort(F.collect_list(F.when(F.col("removable") == flag, F.struct("start", "length", "first_doc"))))
    found = repeated_spans(docs, text, min_run).groupBy("doc_id", "h").agg(place(False).alias("spans"), place(True).alias("removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("key", F.xxhash64(F.col("row")[text]))
    return rows.join(found, (F.col("row")["doc_id"] == F.col("doc_id")) & (F.col("key") == F.col("h")), "left").select("row", "spans", "removed")


def mark_repeats(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``doc_id, n_chars, n_repeated, n_removed, spans`` for every row of ``docs``.

    ``n_repeated`` counts the code points in repeated passages (``spans``), ``n_removed``
    those in passages that documents of smaller id hold. Nulls, empty texts and repeated rows
    as in :func:`repeated_spans`; other columns do not come back.
    """
    found = _by_text(docs.select("doc_id", F.col(text).alias("text")), "text", min_run)
    total = lambda spans: F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["length"]), F.lit(0))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(F.length("row.text"), F.lit(0)).cast("long").alias("n_chars"),
        total("spans").alias("n_repeated"), total("removed").alias("n_removed"), "spans",
    )


def _cutter(batches):
    """The text without the removed spans."""
    for batch in batches:
        texts = []
        for value, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for span in reversed(spans or ()):
                value = value[: span["start"]] + value[span["start"] + span["length"] :]
            texts.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2)], ["kept", "row"])


def dedup_substrings(docs: DataFrame, text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` without the passages that documents of smaller id hold. All rows and columns stay, and every passage where its id is smallest.

    Nulls and empty texts stay as they are.
    """
    marked = _by_text(docs, text, min_run).select(F.col("row")[text].alias("text"), "removed", "row")
    kept = marked.mapInArrow(_cutter, f"kept string, row {marked.schema['row'].dataType.simpleString()}")
    return kept.select(*[F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
