"""Near-duplicate documents by SetSketch registers.

Documents with the same set of word shingles form a class, and one of a class goes on.
Bands of registers bring similar classes into buckets. In a bucket every member is held
against one centre, first by the likelihood of their registers, then on their full sets;
the links give components. Buckets whose members still lie in different components are
held against another centre, and only what is then left is compared in full, block by
block inside tasks and each pair in one bucket only: again registers first, then full sets. A hot bucket is so settled by few links a member, and no pair of two
members of one component is ever a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded
from shelfwise.llm.components import components
from shelfwise.llm.setsketch import REGISTERS, band_keys, band_shape, may_reach, sketch
from shelfwise.llm.words import SPACES, buffer_of, shingle_hashes, slabs, word_hashes
from shelfwise.workspace import Written, discard, write_down

#: Members of one block of a bucket whose pairs are compared.
BLOCK = 256
#: So many ids of documents whose sets are needed go to every task at most; with more, texts are shuffled.
BROADCAST_IDS = 1_000_000
#: A centre's members are dealt over so many tasks at least.
PIECES = 64


def _sketcher(size: int):
    def run(batches):
        for batch in batches:
            ids, (data, offsets) = batch.column(0), buffer_of(batch.column(1))
            counts, digests, registers = [], [], []
            for a, b in slabs(offsets, 1 << 18):
                words, limits = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACES)
                shingles, limits = shingle_hashes(words, limits, size)
                counts.append(np.diff(limits))
                digests += [xxhash.xxh3_128_digest(shingles[x:y].tobytes()) for x, y in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
                registers += [r.tobytes() for r in sketch(shingles, limits)]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(registers, pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "registers"],
            )

    return run


def sketch_documents(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2`` (digest of the set) and ``registers`` of every row."""
    return docs.select("doc_id", text).mapInArrow(
        _sketcher(shingle), f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, d1 long, d2 long, registers binary"
    )


def _bander(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for a in range(0, len(registers), 2048):
                keys = band_keys(registers[a : a + 2048], bands, rows)
                take = pa.array(np.repeat(np.arange(a, a + len(keys)), bands))
                keys = keys & ~np.int64(63) | np.arange(bands)  # the band in the last six bits
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(take)], ["key", "id"])

    return run


def _pairs_of_centres(pairs: DataFrame) -> DataFrame:
    """``id, at`` for both ends of ``pairs`` (``a`` the centre): the pieces of centres where it is needed."""
    pieces = max(PIECES, pairs.count() // 20_000)
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(pieces)).cast("int").alias("piece"))
    member = dealt.select(F.col("b").alias("id"), F.struct("a", "piece", F.lit(1).alias("role")).alias("at"))
    centre = dealt.select("a", "piece").distinct().select(F.col("a").alias("id"), F.struct("a", "piece", F.lit(0).alias("role")).alias("at"))
    return centre.union(member).groupBy("id").agg(F.collect_list("at").alias("at"))


def _judge_registers(per_cent: int):
    def judge(centre: tuple, members: list[tuple]) -> np.ndarray:
        own = np.frombuffer(centre[1], np.uint16)
        other = np.frombuffer(b"".join(m[1] for m in members), np.uint16).reshape(len(members), -1)
        sizes = np.array([m[2] for m in members])
        return may_reach((own > other).sum(1), (own < other).sum(1), len(own), np.full(len(members), centre[2]), sizes, per_cent / 100)[0]

    return judge


def _judge_sets(per_cent: int):
    def judge(centre: tuple, members: list[tuple]) -> np.ndarray:
        own = np.frombuffer(centre[1], np.uint64)
        out = np.zeros(len(members), bool)
        for i, (_, payload, _) in enumerate(members):
            other = np.frombuffer(payload, np.uint64)
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[at] == other).sum())
            out[i] = 100 * both >= per_cent * (len(own) + len(other) - both)
        return out

    return judge


def _held_against(judge):
    """Rows sorted so that a centre comes before its members; yields the pairs that pass."""

    def run(batches):
        at, centre, members, passed = None, None, [], []

        def settle():
            if members:
                fits = judge(centre, members)
                passed.extend((at[0], m[0]) for m, ok in zip(members, fits.tolist(), strict=True) if ok)
                members.clear()

        kinds = None
        for batch in batches:
            kinds = batch.schema.field("a").type
            for a, piece, role, i, payload, n in zip(*(batch.column(c).to_pylist() for c in ("a", "piece", "role", "id", "payload", "n")), strict=True):
                if (a, piece) != at:
                    settle()
                    at, centre = (a, piece), None
                if role == 0:
                    centre = (i, payload, n)
                elif centre is not None:
                    members.append((i, payload, n))
                    if len(members) >= 512:
                        settle()
        settle()
        if passed:
            a, b = zip(*passed, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, kinds), pa.array(b, kinds)], ["a", "b"])

    return run


def _hold(needed: DataFrame, judge, kind: str) -> DataFrame:
    """Pairs that pass, from rows ``id, payload, n`` with the places ``at`` where each is needed."""
    rows = needed.select("id", "payload", "n", F.explode("at").alias("p")).select("p.a", "p.piece", "p.role", "id", "payload", "n")
    return rows.repartition("a", "piece").sortWithinPartitions("a", "piece", "role").mapInArrow(_held_against(judge), f"a {kind}, b {kind}")


def _set_maker(size: int):
    def run(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            sets, counts = [], []
            for a, b in slabs(offsets):
                words, limits = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACES)
                shingles, limits = shingle_hashes(words, limits, size)
                sets += [shingles[x:y].tobytes() for x, y in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
                counts.append(np.diff(limits))
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), pa.array(n)], ["id", "payload", "n"])

    return run


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``id`` is among the distinct ``ids`` (a written table); ``df`` stays where it is while they are few."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, "id", "left_semi")


class _Linker:
    """Holds pairs of classes against each other, by registers and by full sets."""

    def __init__(self, docs: DataFrame, text: str, shingle: int, reps: DataFrame, per_cent: int, kind: str):
        self.docs, self.text, self.shingle = docs, text, shingle
        self.reps, self.per_cent, self.kind = reps, per_cent, kind

    def sets(self, ids: DataFrame) -> DataFrame:
        """``id, payload, n``: the sets of the documents ``ids`` (distinct, written)."""
        texts = _only(self.docs.select(F.col("doc_id").alias("id"), F.col(self.text).alias("text")), ids)
        return texts.mapInArrow(_set_maker(self.shingle), f"id {self.kind}, payload binary, n long")

    def sized(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` whose sizes allow the similarity."""
        size = self.reps.select("id", F.col("n_shingles").alias("n"))
        small, large = F.least("n", "m"), F.greatest("n", "m")
        return (
            pairs.join(size.withColumnRenamed("id", "b"), "b")
            .join(size.select(F.col("id").alias("a"), F.col("n").alias("m")), "a")
            .where(small * 100 >= large * self.per_cent)
            .select("a", "b")
        )

    def links(self, pairs: Written) -> Written:
        """The linked ones of ``pairs``."""
        payload = self.reps.select("id", F.col("registers").alias("payload"), F.col("n_shingles").alias("n"))
        places = write_down(_pairs_of_centres(pairs.table), "places")
        held = _only(payload, places.table.select("id")).join(places.table, "id")
        likely = write_down(_hold(held, _judge_registers(self.per_cent), self.kind), "likely")
        links = self.confirmed(likely)
        for table in (places, likely):
            discard(self.reps.sparkSession, table.path)
        return links

    def confirmed(self, pairs: Written) -> Written:
        places = write_down(_pairs_of_centres(pairs.table), "places")
        held = _hold(self.sets(places.table.select("id")).join(places.table, "id"), _judge_sets(self.per_cent), self.kind)
        links = write_down(held, "confirmed")
        discard(self.reps.sparkSession, places.path)
        return links


def _linked(own: np.ndarray, other: np.ndarray, per_cent: int) -> bool:
    both = int((own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other).sum())
    return 100 * both >= per_cent * (len(own) + len(other) - both)


def _block_links(per_cent: int, kind: str, bands: int, rows: int):
    linked = _linked

    def compare(table: pa.Table) -> pa.Table:
        ids, comp, side = table["id"].to_pylist(), np.array(table["component"].to_pylist()), table["side"].to_numpy()
        n, band = table["n"].to_numpy(), table["key"][0].as_py() & 63
        registers = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(len(ids), -1)
        # Keys of the bands whose buckets are compared, before this one; a pair counts in the first it shares.
        open_ = (table["mask"].to_numpy()[:, None] >> np.arange(band)) & 1 == 1
        keys = np.where(open_, band_keys(registers, bands, rows)[:, :band] & ~np.int64(63), np.arange(len(ids))[:, None])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        same = table["bi"][0].as_py() == table["bj"][0].as_py()
        found = []
        for k, i in enumerate(left.tolist()):
            others = right[k + 1 :] if same else right
            others = others[(comp[others] != comp[i]) & (np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * per_cent)]
            others = others[~(keys[others] == keys[i]).any(1)]
            if len(others):
                own, theirs = registers[i], registers[others]
                found.append(np.stack([np.full(len(others), i), others, (own > theirs).sum(1), (own < theirs).sum(1)], 1))
        # The likeliest first; once two components are linked here, their other pairs change nothing.
        root = {c: c for c in comp.tolist()}

        def top(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        sets: dict[int, np.ndarray] = {}
        out_a, out_b = [], []
        every = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
        for at in range(0, len(every), 16384):
            i, j, more, less = every[at : at + 16384].T
            close, alike = may_reach(more, less, registers.shape[1], n[i], n[j], per_cent / 100)
            order = np.flatnonzero(close)[np.argsort(-alike[close], kind="stable")]
            for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
                a, b = top(comp[x].item()), top(comp[y].item())
                if a == b:
                    continue
                for z in (x, y):
                    if z not in sets:
                        sets[z] = np.frombuffer(table["payload"][z].as_py(), np.uint64)
                if linked(sets[x], sets[y], per_cent):
                    root[max(a, b)] = min(a, b)
                    out_a.append(min(ids[x], ids[y]))
                    out_b.append(max(ids[x], ids[y]))
        field = table.schema.field("id").type
        return pa.table({"a": pa.array(out_a, field), "b": pa.array(out_b, field)})

    return compare


def _unsettled(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """``key, id, component, members`` of the buckets whose members, but for the centre, span components.

    Of buckets with the same members one stays.
    """
    at = buckets.where(F.col("id") != F.col("centre")).select("key", "id")
    at = at.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    spans = (
        at.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("sign"))
        .where(F.col("lo") < F.col("hi"))
        .groupBy("n", "sign")
        .agg(F.min("key").alias("key"))
        .select("key", F.col("n").alias("members"))
    )
    return at.join(spans, "key")


def _other_centre(unsettled: DataFrame) -> DataFrame:
    """Pairs of the members with another centre, drawn by hash, where components differ."""
    drawn = unsettled.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key").alias("h"), F.col("id").alias("a"), F.col("component").alias("ca"))).alias("c"))
    pairs = unsettled.join(drawn, "key").where(F.col("component") != F.col("c.ca"))
    return pairs.select(F.col("c.a").alias("a"), F.col("id").alias("b")).distinct()


def _links_left(unsettled: DataFrame, linker: _Linker, bands: int, rows: int) -> DataFrame:
    """Links across components that settle them, each pair compared in the first bucket that holds both."""
    masks = write_down(unsettled.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, CAST(key & 63 AS INT))")).alias("mask")), "masks").table
    dealt = unsettled.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    needed = masks.select("id")
    known = _only(linker.reps.select("id", "registers"), needed).join(masks, "id").join(linker.sets(needed), "id")
    blocks = dealt.join(known, "id").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("mine", "o").alias("bi"), F.greatest("mine", "o").alias("bj"),
        F.when(F.col("mine") == F.col("o"), 2).otherwise(F.when(F.col("mine") < F.col("o"), 0).otherwise(1)).alias("side"),
        "id", "component", "n", "mask", "registers", "payload",
    )
    compare = _block_links(linker.per_cent, linker.kind, bands, rows)
    return blocks.groupBy("key", "bi", "bj").applyInArrow(compare, f"a {linker.kind}, b {linker.kind}").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = 5, per_cent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id`` and a text).

    Words are runs of other than ASCII white space, A-Z lower-cased. A set holds the
    distinct ``shingle``-word shingles; a text of fewer words has its whole sequence as the
    one shingle, and one without words (or a null) an empty set that is linked with nothing.
    Two documents are linked when 100 * intersection >= ``per_cent`` * union. The component
    is the smallest ``doc_id`` reachable over links, and ``kept`` says that it is the row's
    own. Rows of one ``doc_id`` count as one document, so repeated rows are kept alike; a
    row without ``doc_id`` is linked with nothing and kept, its component null.
    """
    spark, kind = bounded(docs).sparkSession, dict(docs.dtypes)["doc_id"]
    bands, rows = band_shape(per_cent / 100)
    gone: list[Written] = []

    def keep(df: DataFrame, name: str) -> Written:
        gone.append(write_down(df, name))
        return gone[-1]

    sketches = write_down(sketch_documents(docs, text, shingle), "sketches")
    some = sketches.table.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    reps = keep(
        some.groupBy("d1", "d2").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")), "classes"
    ).table
    keyed = reps.select("id", "registers").mapInArrow(_bander(bands, rows), f"key long, id {kind}")
    shared = keyed.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("members")).where(F.col("members") > 1)
    buckets = keep(keyed.join(shared, "key").select("key", "id", "centre"), "buckets").table
    linker = _Linker(docs, text, shingle, reps, per_cent, kind)
    star = buckets.where(F.col("id") != F.col("centre")).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    tried = keep(linker.sized(star), "pairs")
    links = linker.links(tried)
    gone.append(links)
    comps = components(links.table)
    gone.append(comps)
    # Another centre joins most of what the first has missed; the rest is compared in full.
    for full in (False, True):
        open_ = keep(_unsettled(buckets, comps.table), "unsettled").table
        if full:
            more = keep(_links_left(open_, linker, bands, rows), "links")
        else:
            fresh = keep(linker.sized(_other_centre(open_)).join(tried.table, ["a", "b"], "left_anti"), "pairs")
            more = linker.links(fresh)
            gone.append(more)
        if more.table.limit(1).count():
            links = keep(links.table.union(more.table), "links")
            comps = components(links.table)
            gone.append(comps)
    named = write_down(
        reps.select("d1", "d2", "id").join(comps.table, "id", "left").select("d1", "d2", F.coalesce("component", "id").alias("_c")), "named"
    )
    for table in gone:
        discard(spark, table.path)
    return _labelled(sketches, named)


def _labelled(sketches: Written, named: Written) -> DataFrame:
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    out = sketches.table.select("doc_id", "n_shingles", "d1", "d2").join(named.table, ["d1", "d2"], "left")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def dedup_documents(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of near-duplicates (the smallest id), with its own columns."""
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
