"""Lines that many documents hold are taken out of all of them.

Distinct line keys are counted as 128-bit hashes. Those that reach the threshold are cut
into shards; each shard becomes a minimal perfect hash that indexes an array of 64-bit
fingerprints and one of counts, about 10 bytes a line. Documents probe the arrays where
they are read: no line is joined and no text is shuffled. Arrays are broadcast in waves of
at most ``wave_bytes``; more arrays mean more waves, each over what the last one left.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import perfect_hash
from shelfwise.llm.batches import bounded
from shelfwise.workspace import discard, write_down

BLANKS = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 1 << 17
_build, _counts_of = perfect_hash.build, perfect_hash.counts_of


def _line_counts(batches):
    """Per batch: hash halves of each line key, and how many rows hold it."""
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        held: Counter = Counter()
        for text in batch.column(0).cast(pa.large_binary()):
            value = text.as_py()
            if value:
                held.update({digest(key) for line in value.split(b"\n") if (key := line.strip(BLANKS).lower())})
        halves = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(list(held.values()), pa.int64())],
            ["h1", "h2", "n"],
        )


def count_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h1, h2, n``: hash halves of every distinct line key and the documents that hold it."""
    parts = docs.select(text).mapInArrow(_line_counts, "h1 long, h2 long, n long")
    return parts.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def _shard(table: pa.Table) -> pa.Table:
    h1, h2 = (table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    blob = _build(h1, h2, table["n"].to_numpy())
    return pa.table({"shard": table["shard"].slice(0, 1), "blob": pa.array([blob], pa.binary())})


def index_lines(counts: DataFrame, shards: int) -> DataFrame:
    """``shard, blob``: one packed perfect hash per shard of the counted keys."""
    keyed = counts.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))
    return keyed.groupBy("shard").applyInArrow(_shard, "shard int, blob binary")


def _prober(arrays, shards: int, min_docs: int, at: int, names: list[str]):
    def probe(batches):
        digest = xxhash.xxh3_128_digest
        packed = {shard: pickle.loads(blob) for shard, blob in arrays.value.items()}
        for batch in batches:
            column = batch.column(at).cast(pa.large_binary())
            lines, owner, place, hashes = [], [], [], []
            for row in range(len(column)):
                each = (column[row].as_py() or b"").split(b"\n")
                lines.append(each)
                for i, line in enumerate(each):
                    if key := line.strip(BLANKS).lower():
                        owner.append(row)
                        place.append(i)
                        hashes.append(digest(key))
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            h1, h2 = halves[:, 0].copy().view(np.uint64), halves[:, 1].copy().view(np.uint64)
            shard = np.mod(halves[:, 0], shards)
            found = np.zeros(len(h1), np.int64)
            for s, index in packed.items():
                mine = np.flatnonzero(shard == s)
                found[mine] = _counts_of(index, h1[mine], h2[mine])
            total, dropped = [len(x) for x in lines], [0] * len(lines)
            for j in np.flatnonzero(found >= min_docs).tolist():
                lines[owner[j]][place[j]] = None
                dropped[owner[j]] += 1
            kept = [b"\n".join(line for line in x if line is not None) if d else b"\n".join(x) for x, d in zip(lines, dropped, strict=True)]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            old = batch.schema.names[at]
            columns[old] = pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.types[at])
            if "n_lines" in columns:  # a later wave
                columns["n_dropped"] = pa.array(np.asarray(dropped, np.int64) + columns["n_dropped"].to_numpy())
            else:
                columns |= {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return probe


def dedup_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, wave_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` without the lines whose key at least ``min_docs`` documents hold.

    A key is a line without white space at its ends, A-Z lower-cased; a blank line has none
    and stays. Adds ``n_lines`` (before) and ``n_dropped``, in place of columns of these
    names. A null or empty text is one empty line and comes back empty. Repeated rows count
    as so many documents; an empty table gives an empty one.
    """
    spark = bounded(docs).sparkSession
    counted = write_down(count_lines(docs, text).where(F.col("n") >= min_docs), "lines")
    shards = counted.table.count() // SHARD_KEYS + 1
    index = write_down(index_lines(counted.table, shards), "line-index")
    sizes = sorted((r[0], r[1]) for r in index.table.select("shard", F.length("blob")).collect())
    waves: list[list[int]] = [[]]
    filled = 0
    for shard, size in sizes:
        if filled and filled + size > wave_bytes:
            waves.append([])
            filled = 0
        waves[-1].append(shard)
        filled += size
    out = docs.drop("n_lines", "n_dropped")
    before = None
    for wave in waves:
        rows = index.table.where(F.col("shard").isin(wave)).collect()
        arrays = spark.sparkContext.broadcast({r["shard"]: bytes(r["blob"]) for r in rows})
        schema = T.StructType([f for f in out.schema.fields if f.name not in ("n_lines", "n_dropped")])
        schema = schema.add("n_lines", "long").add("n_dropped", "long")
        out = out.mapInArrow(_prober(arrays, shards, min_docs, out.columns.index(text), schema.names), schema)
        if wave is not waves[-1]:
            step = write_down(out, "lines-left")
            if before:
                discard(spark, before)
            out, before = step.table, step.path
    discard(spark, counted.path)
    discard(spark, index.path)
    return out
