"""Sources interleaved to target weights by Pfair scheduling.

A source's documents are cut into blocks. Served in parallel and without rounding, source s
of weight w and n blocks would have got min(n, w * v) blocks at virtual time v, and slot
number t(v) is the sum of these over all sources; so a source that runs out leaves its share
to the others. Block i (from 0) is released at slot floor(t(i / w)) and due before slot
ceil(t((i + 1) / w)); every slot goes to the released block that is due first. Such a
schedule always exists (the unrounded one fills every window) and the earliest deadline
finds it, so no source is ever a whole block off the unrounded service.

The slots are dealt by one task that streams them: it holds some numbers per source, never
per block, and the driver holds neither.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.workspace import discard, write_down

#: Rows of one source that are numbered in one task, about.
BUCKET_ROWS = 5_000
#: Slots of one batch of the dealing task.
BATCH_SLOTS = 10_000
#: Releases and deadlines so near to a whole slot are that slot: what floating point may be off.
EPS = 1e-6


class Phase(NamedTuple):
    """Slots from ``start`` on: ``slots[s]`` are the places of source s in a period, ``first[s]`` its first block here."""

    start: int
    length: int
    period: int
    slots: dict[str, list[int]]
    first: dict[str, int]
    last: dict[str, int]


def shares(weights: dict, period: int) -> dict:
    """Slots of a period for each weight: largest remainders, one at least."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    spare = period - sum(out.values())
    order = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    while spare > 0:
        for s in order[:spare]:
            out[s] += 1
        spare = period - sum(out.values())
    while spare < 0:  # ones granted to tiny weights, taken from the largest
        s = max(out, key=lambda s: (out[s], str(s)))
        cut = min(-spare, max(1, out[s] // 2)) if out[s] > 1 else 0
        out[s] -= cut
        spare += cut
    return out


def one_period(counts: dict, period: int) -> dict[str, list[int]]:
    """Slots of each source by earliest deadline among the released blocks."""
    order = {s: i for i, s in enumerate(sorted(counts, key=str))}
    releases: dict[int, list] = {}
    for s, n in counts.items():
        for i in range(n):
            releases.setdefault(i * period // n, []).append((-(-(i + 1) * period // n), order[s], i, s))
    ready: list = []
    slots: dict[str, list[int]] = {s: [] for s in counts}
    for slot in range(period):
        for item in releases.get(slot, ()):
            heapq.heappush(ready, item)
        slots[heapq.heappop(ready)[3]].append(slot)
    return slots


def deal(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """Source and block of every slot in turn; ties go to the source that stands first."""
    sources = range(len(blocks))
    ends = sorted(sources, key=lambda s: blocks[s] / weights[s])
    finish = [blocks[s] / weights[s] for s in ends]
    gone = [0, *accumulate(blocks[s] for s in ends)]
    rate = [0.0, *accumulate(weights[s] for s in reversed(ends))][::-1]

    def time(s: int, i: int) -> float:
        v = i / weights[s]
        k = bisect_right(finish, v)
        return gone[k] + v * rate[k] if k < len(finish) else float(gone[k])

    def due(at: float) -> int:
        return -int(-(at - EPS) // 1)

    def timed(s: int, i: int) -> tuple:
        """Deadline, source, block and, for the release of the next block, the unrounded deadline."""
        end = time(s, i + 1)
        return due(end), s, i, end

    ready = [timed(s, 0) for s in sources]
    heapq.heapify(ready)
    waiting: list[tuple] = []
    for slot in range(gone[-1]):
        while waiting and (waiting[0][0] <= slot or not ready):
            heapq.heappush(ready, heapq.heappop(waiting)[1])
        _, s, i, end = heapq.heappop(ready)
        yield s, i
        if i + 1 < blocks[s]:
            release, job = int(end + EPS), timed(s, i + 1)
            if release <= slot + 1:
                heapq.heappush(ready, job)
            else:
                heapq.heappush(waiting, (release, job))


def phases(blocks: dict, weights: dict, period: int | None = None) -> list[Phase]:
    """The whole plan for ``blocks`` blocks of each source as lists: one phase, whatever ``period``."""
    left = sorted((s for s, n in blocks.items() if n > 0), key=str)
    if not left:
        return []
    slots: dict[str, list[int]] = {s: [] for s in left}
    for slot, (s, _) in enumerate(deal([blocks[s] for s in left], [float(weights[s]) for s in left])):
        slots[left[s]].append(slot)
    total = sum(blocks[s] for s in left)
    return [Phase(0, total, total, slots, dict.fromkeys(left, 0), {s: blocks[s] for s in left})]


def _dealer(block_docs: int, alpha: float):
    def run(batches):
        rows = sorted(
            row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("s", "n", "w")), strict=True)
        )
        if not rows:
            return
        names = pa.array([s for s, _, _ in rows], pa.string())
        slots = deal([-(-n // block_docs) for _, n, _ in rows], [float(n) ** alpha if w is None else w for _, n, w in rows])
        held: list[tuple[int, int]] = []
        first = 0

        def batch():
            source, block = zip(*held, strict=True)
            places = range(first, first + len(held))
            return pa.RecordBatch.from_arrays([names.take(pa.array(source)), pa.array(block, pa.int64()), pa.array(places, pa.int64())], ["s", "block", "slot"])

        for place in slots:
            held.append(place)
            if len(held) == BATCH_SLOTS:
                yield batch()
                first += len(held)
                held.clear()
        if held:
            yield batch()

    return run


def mix_sources(
    docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", doc_id: str = "doc_id",
    block_docs: int = 16, alpha: float = 0.5, period: int = 1000, max_sources: int | None = None,
) -> DataFrame:
    """``docs`` with ``block`` (of the source, from 0), ``slot`` and ``position`` in the mix.

    ``slot`` numbers the blocks of the mix from 0, and ``position`` tells the documents
    apart: slot * ``block_docs`` + place in the block, so ordering by it gives the mix. The
    columns take the place of others of these names. ``weights`` gives a target weight to
    every source (a null source has the key None); without it a source weighs its number of
    documents to the power ``alpha``. At every slot every source has less than one block
    more or less than its weight, unrounded, has earned it so far; what a source that ran
    out would have earned goes to the others by their weights. ``period`` changes nothing:
    weights are no longer rounded to it. Documents of a source come in the order of a hash
    of their id, then the id; repeated rows and rows without an id have places of their own.
    All rows stay; an empty table gives an empty one. There may be any number of sources,
    unless the caller gives ``max_sources``: more of them are refused then.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("block", "slot", "position")]
    hashed = F.xxhash64(F.col(doc_id).cast("string"))
    parts = max(1, docs.count() // BUCKET_ROWS)
    dealt = docs.select(
        F.struct(*kept).alias("doc"),
        # a null source is a source of its own
        F.coalesce(F.concat(F.lit("s:"), F.col(source).cast("string")), F.lit("null")).alias("s"),
        F.pmod(F.shiftright(hashed, 20), F.lit(parts)).cast("int").alias("part"),
        hashed.alias("h"),
    )
    counts = write_down(dealt.groupBy("s", "part").agg(F.count("*").alias("n")), "mix-counts")
    totals = counts.table.groupBy("s").agg(F.sum("n").alias("n"))
    if max_sources is not None and totals.limit(max_sources + 1).count() > max_sources:
        raise ValueError(f"more than {max_sources} sources to mix")
    if weights is None:
        weighed = totals.withColumn("w", F.lit(None).cast("double"))
    else:
        target = spark.createDataFrame([("null" if s is None else f"s:{s}", float(w)) for s, w in weights.items()], "s string, w double")
        weighed = totals.join(target, "s", "left")
        missing = weighed.where(~F.coalesce(F.col("w") > 0, F.lit(False))).orderBy("s").limit(5).collect()
        if missing:
            raise ValueError(f"no positive weight for sources: {[r['s'] for r in missing]}")
    plan = write_down(weighed.select("s", "n", "w").repartition(1).mapInArrow(_dealer(block_docs, alpha), "s string, block long, slot long"), "mix-slots")
    # Each part of a source gets the slots of its blocks, in order: no text moves for them.
    before = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.table.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    block_of = lambda place: F.floor(place / block_docs).cast("long")
    wanted = starts.select("s", "part", "start", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("start") + F.col("n") - 1))).alias("block"))
    places = (
        wanted.join(plan.table, ["s", "block"]).groupBy("s", "part")
        .agg(F.min("start").alias("start"), F.array_sort(F.collect_list("slot")).alias("slots"))
    )
    places = write_down(places, "mix-places")
    discard(spark, counts.path)
    discard(spark, plan.path)
    number = F.row_number().over(Window.partitionBy("s", "part").orderBy("h", f"doc.{doc_id}")) - 1
    numbered = dealt.withColumn("i", number).join(places.table, ["s", "part"]).withColumn("i", F.col("i") + F.col("start"))
    return (
        numbered.withColumn("block", block_of(F.col("i")))
        .withColumn("slot", F.col("slots")[(F.col("block") - block_of(F.col("start"))).cast("int")])
        .withColumn("position", F.col("slot") * block_docs + F.pmod(F.col("i"), F.lit(block_docs)))
        .select("doc.*", "block", "slot", "position")
    )
