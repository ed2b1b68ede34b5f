"""Phrases whose words stand together more often than their parts would have it.

Counts of phrases of every length are streams. One is kept in prefix order (language, then
the words from the left), one in suffix order (the words from the right). In prefix order
a phrase stands right behind its own beginnings and before its extensions to the right, so
one pass in lockstep, with the open beginnings on a stack, yields the counts of all first
parts and the most frequent extension; suffix order yields the last parts and the
extensions to the left. Nothing is looked up by hash. Streams are sorted over the cluster
by range, so a first word with any number of phrases is spread over blocks; what a block
misses at its begin, or does not see beyond its end, is one short chain of beginnings,
which is settled afterwards.

Counting goes by length. A phrase can reach the threshold only if its first and last parts,
one word shorter, do; a filter of bits of fixed size, made from the shorter frequent
phrases, leaves out most others. It never leaves out a frequent one, however full it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded
from shelfwise.workspace import Written, discard, write_down

#: Bytes of text counted at once, rows of a block of a stream, and bits of the filter (8 MB) as a power of two.
SLAB, BLOCK_ROWS, FILTER_BITS = 2 << 20, 200_000, 26
_BREAK, _SPACE = 10, 32
_FROM = bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d\x09"
_TO = bytes(range(97, 123)) + b"\n" * 10 + b" "
PLAIN = bytes.maketrans(_FROM, _TO)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slabs(batch: pa.RecordBatch):
    """``(lang, bytes)``: texts of one language, lower-cased, pieces ended by newlines, about ``SLAB`` bytes at a time."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
        data = (text.as_py() or b"").translate(PLAIN)
        lang = lang.as_py()
        while len(data) > SLAB:  # a piece is never cut
            cut = data.rfind(b"\n", 0, SLAB)
            cut = data.find(b"\n", SLAB) if cut < 0 else cut
            if cut < 0:
                break
            yield lang, data[:cut]
            data = data[cut + 1 :]
        held.setdefault(lang, []).append(data)
        sizes[lang] = sizes.get(lang, 0) + len(data)
        if sizes[lang] >= SLAB:
            yield lang, b"\n".join(held.pop(lang))
            del sizes[lang]
    for lang, texts in held.items():
        yield lang, b"\n".join(texts)


def _words(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, and for every word in order its place among them and its piece."""
    chars = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(chars) + 2, bool)
    inside[1:-1] = (chars != _SPACE) & (chars != _BREAK)
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    lengths = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    packed = chars[inside[1:-1]].tobytes()
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    piece = np.cumsum(chars == _BREAK, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece


def _hashes(words) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64)


def _folded(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase from those of its words, one array a position."""
    out = np.full(len(words[0]), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for each in words:
        out = (out ^ each) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _spots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _may_be(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for spot in _spots(hashes, bits):
        out &= (filter_[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _counter(length: int, shared, bits: int):
    """Counts of the phrases of ``length`` words whose parts pass the filter, exact within each slab."""

    def run(batches):
        filter_ = shared.value if shared else None
        for batch in batches:
            for lang, data in _slabs(batch):
                distinct, ids, piece = _words(data)
                at = np.flatnonzero(piece[: len(piece) - length + 1] == piece[length - 1 :])
                if filter_ is not None and len(at):
                    hashes = _hashes(distinct.to_pylist())[ids]
                    part = [hashes[i : len(hashes) - length + 2 + i] for i in range(length - 1)]
                    passes = _may_be(filter_, _folded(lang, part), bits)
                    at = at[passes[at] & passes[at + 1]]
                if not len(at):
                    continue
                key, span = ids[at], len(distinct)
                for i in range(1, length):
                    if span * len(distinct) >= 1 << 62:
                        known, key = np.unique(key, return_inverse=True)
                        span = len(known)
                    key, span = key * len(distinct) + ids[at + i], span * len(distinct)
                _, first, counts = np.unique(key, return_index=True, return_counts=True)
                words = [distinct.take(pa.array(ids[at[first] + i])) for i in range(length)]
                phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if length > 1 else words[0]
                for row in range(0, len(first), 100_000):
                    some = phrases.slice(row, 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), some.cast(pa.binary()).view(pa.string()), pa.array(counts[row : row + 100_000])],
                        ["lang", "phrase", "c"],
                    )

    return run


def _bits_of(length: int, bits: int):
    """The filter's 64-bit cells that a batch of phrases sets."""

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            words = [p.split(b" ") for p in batch.column(1).cast(pa.binary()).to_pylist()]
            for lang in set(langs.tolist()):
                mine = np.flatnonzero(langs == lang)
                hashes = _folded(lang, [_hashes([words[j][i] for j in mine]) for i in range(length)])
                spots = np.concatenate(_spots(hashes, bits))
                cells, place = np.unique(spots >> np.uint64(6), return_inverse=True)
                values = np.zeros(len(cells), np.uint64)
                np.bitwise_or.at(values, place, np.uint64(1) << (spots & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(values.view(np.int64))], ["cell", "value"])

    return run


def _filter(frequent: DataFrame, length: int, bits: int) -> np.ndarray:
    """Bits of the frequent phrases. 2 ** ``bits`` of them whatever the corpus, so they may pass through the driver."""
    cells = frequent.select("lang", "phrase").mapInArrow(_bits_of(length, bits), "cell long, value long").groupBy("cell").agg(F.bit_or("value").alias("value"))
    found = cells.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["cell"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return out


def count_phrases(docs: DataFrame, words: int, min_count: int, bits: int = FILTER_BITS) -> tuple[list[Written], Written]:
    """Frequent phrases ``lang, phrase, f`` by length, and ``lang, n``: all word occurrences. ``docs`` has lang, text."""
    context, levels, shared = docs.sparkSession.sparkContext, [], None
    for length in range(1, words + 1):
        counted = docs.mapInArrow(_counter(length, shared, bits), "lang string, phrase string, c long")
        counted = counted.groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
        if length == 1:
            every = write_down(counted, "words")
            totals = write_down(every.table.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
            counted = every.table
        levels.append(write_down(counted.where(F.col("f") >= min_count), f"phrases-{length}"))
        if length < words:
            shared = context.broadcast(_filter(levels[-1].table, length, bits))
    discard(docs.sparkSession, every.path)
    return levels, totals


def _lockstep(batches):
    """Over a block of a stream: each phrase with the counts of its beginnings and of its most frequent extension.

    A beginning that lies in an earlier block gets a row without count.
    """
    stack: list[list] = []  # lang, words, f, carry, best; each a beginning of the next
    out: list[tuple] = []

    def close(keep: int) -> None:
        while len(stack) > keep:
            lang, words, f, carry, best = stack.pop()
            out.append((block, lang, words, f, carry, [x[2] for x in stack], best))

    block = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for block_, lang, words, f, carry in zip(*columns):
            block = block_
            depth = 0
            while depth < len(stack) and depth < len(words) - 1 and stack[depth][0] == lang and stack[depth][1][depth] == words[depth]:
                depth += 1
            close(depth)
            for missing in range(depth, len(words) - 1):
                stack.append([lang, words[: missing + 1], None, None, None])
            if stack:
                stack[-1][4] = f if stack[-1][4] is None else max(stack[-1][4], f)
            stack.append([lang, words, f, carry, None])
        yield _closed(out)
        out.clear()
    close(0)
    yield _closed(out)


def _closed(rows: list[tuple]) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.string(), pa.list_(pa.string()), pa.int64(), longs, longs, pa.int64()]
    columns = list(zip(*rows)) or [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "lang", "words", "f", "carry", "parts", "best"])


def along(stream: DataFrame, name: str) -> Written:
    """``lang, words, f, carry`` with ``parts``, the counts of the beginnings of ``words`` by length, and ``best``,
    that of the most frequent extension by one word (null if none): a sort by range and a pass in lockstep."""
    spark = stream.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), stream.count() // BLOCK_ROWS + 1)
    ordered = stream.repartitionByRange(blocks, "lang", "words").sortWithinPartitions("lang", "words")
    ordered = bounded(ordered.select(F.spark_partition_id().alias("block"), "lang", "words", "f", "carry"))
    passed = write_down(
        ordered.mapInArrow(_lockstep, "block int, lang string, words array<string>, f long, carry array<long>, parts array<long>, best long"), name
    )
    # At most one chain of beginnings a block has no count there.
    ghosts = passed.table.where("f IS NULL").select("block", "lang", "words", "best")
    found = passed.table.where("f IS NOT NULL")
    counts = found.select("lang", "words", "f").join(F.broadcast(ghosts), ["lang", "words"])
    counts = write_down(counts, f"{name}-seams").table
    chain = counts.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.size("words").alias("k"), "f"))).alias("chain"))
    more = counts.groupBy("lang", "words").agg(F.max("best").alias("more"))
    whole = found.join(F.broadcast(chain), "block", "left").join(F.broadcast(more), ["lang", "words"], "left")
    # a chain holds beginnings of 1, 2, ... words, from the shortest that is missing: all of the first phrase's in the block
    lacking = F.transform("parts", lambda f, i: F.coalesce(f, F.filter("chain", lambda x: x["k"] == i + 1)[0]["f"]))
    done = write_down(whole.select("lang", "words", "f", "carry", lacking.alias("parts"), F.greatest("best", "more").alias("best")), f"{name}-whole")
    discard(spark, passed.path)
    return done


def _exact(column: Column | str) -> Column:
    return F.col(column).cast("decimal(19,0)") if isinstance(column, str) else column.cast("decimal(19,0)")


def mine_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", words: int = 3, min_count: int = 10, per_cent: int = 50, bits: int = FILTER_BITS
) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` for every phrase of 2 to ``words`` words that occurs at least ``min_count`` times.

    Texts, A-Z lower-cased, are split at ``.,;:!?`` and line ends, words at blanks and tabs;
    phrases lie within a piece and are counted by language, overlaps included. Of the cuts
    into two parts with counts ``l`` and ``r`` the one with the smallest score
    floor(1000000 a a / (l r)) counts, the earliest among equals; ``n`` are all words of
    the language. A phrase goes if one that is longer by a word and holds it has at least
    ``per_cent`` of its count. Arithmetic is exact up to counts of 10 ** 15.

    A null language is ``und``, a null or empty text has no words; repeated rows count each;
    other columns play no part; an empty table gives an empty one.
    """
    rows = bounded(docs).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    levels, totals = count_phrases(rows, words, min_count, bits)
    stream = levels[0].table
    for level in levels[1:]:
        stream = stream.unionByName(level.table)
    nothing = F.lit(None).cast("array<bigint>")
    forward = along(stream.select("lang", F.split("phrase", " ").alias("words"), "f", nothing.alias("carry")), "prefix-order")
    carried = F.concat("parts", F.array(F.coalesce("best", F.lit(0).cast("long")))).alias("carry")
    backward = along(forward.table.select("lang", F.reverse("words").alias("words"), "f", carried), "suffix-order")
    size = F.size("words")
    longer = F.greatest(F.element_at("carry", -1), F.coalesce("best", F.lit(0).cast("long")))
    both = backward.table.where(size > 1).where(100 * longer < per_cent * F.col("f"))
    million = F.lit(1_000_000).cast("decimal(7,0)")

    def cut(k: Column) -> Column:
        left, right = F.element_at("carry", k), F.element_at("parts", size - k)
        score = F.call_function("div", million * (_exact("f") * _exact("f")), _exact(left) * _exact(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    lowest = F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut))
    scored = both.select("lang", F.array_join(F.reverse("words"), " ").alias("phrase"), F.col("f").alias("a"), lowest.alias("x"))
    scored = scored.select("lang", "phrase", "a", F.col("x.l").alias("l"), F.col("x.r").alias("r"), F.col("x.score").alias("score"))
    return scored.join(totals.table, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def best_phrases(phrases: DataFrame, top: int = 2000, parts: int = 64) -> DataFrame:
    """The first ``top`` phrases of each language with their ``rank``: by score, count, then the bytes of the phrase.

    They are chosen in ``parts`` of a language first, so that at most ``parts * top`` rows of one meet.
    """

    def first(rows: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    dealt = phrases.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    return first(first(dealt, "lang", "_part").drop("rank", "_part"), "lang").withColumn("rank", F.col("rank").cast("long"))
