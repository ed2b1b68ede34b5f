"""A bigram language model in Elias-Fano tries, built and queried shard by shard.

With p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)) over training tokens and a Dirichlet prior of
weight m, p(w | u) = (c(u w) + m p(w)) / (c(u) + m). Its logarithm is a sum of log p(w), of
log m - log (c(u) + m), and, for bigrams seen in training, of the gain
log (1 + c(u w) / (m p(w))). Everything but c(u w) belongs to one word. So tokens are
dealt by word: a shard counts its words and their contexts, puts the gains into a trie
(word, then context), and looks up all its tokens, of training and other documents. What
moves is one row per batch of documents and shard, with the tokens packed, and back one
with sums per document. Words that would fill a shard alone are dealt by context as well.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import bounded
from shelfwise.llm.elias_fano import NgramTrie, pack, unpack
from shelfwise.llm.words import SPACES, buffer_of, word_hashes
from shelfwise.workspace import discard, write_down

END, BEGIN = np.uint64(3), np.uint64(5)
#: Tokens of one shard, about; and documents or bytes of one batch at most.
SHARD_TOKENS, BATCH_ROWS, BATCH_BYTES = 3_000_000, 8192, 14 << 20
#: Tries of one shard.
PARTS = 8
#: Weight of the prior, in tokens.
PRIOR = 100.0
_CONTEXT = np.uint64(64 - NgramTrie.CONTEXT_BITS)


def _batches(data: np.ndarray, offsets: np.ndarray):
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + BATCH_BYTES, "right")) - 1
        upto = min(max(upto, row + 1), row + BATCH_ROWS, rows)
        yield row, upto, data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of every row, the end last, and the row limits."""
    words, limits = word_hashes(data, offsets, SPACES)
    return np.insert(words, limits[1:], END), limits + np.arange(len(limits))


def _count_words(batches):
    for batch in _gathered(batches):
        for _, _, data, offsets in _batches(*buffer_of(batch.column(0))):
            words, counts = np.unique(_tokens(data, offsets)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])


def _spread(words: np.ndarray, contexts: np.ndarray, shards: int) -> np.ndarray:
    return (((words ^ (contexts * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(20)) % np.uint64(shards)).astype(np.int32)


def _gathered(batches):
    """Batches joined until they hold ``BATCH_ROWS`` rows or ``BATCH_BYTES``: packed tokens of few documents pay for many headers."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if held and (rows + batch.num_rows > BATCH_ROWS or size + batch.nbytes > BATCH_BYTES):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _packer(shards: int, hot):
    """Per batch of documents: a row with its ids, and a row of packed tokens for each shard."""

    def run(batches):
        part, serial = TaskContext.get().partitionId(), itertools.count()
        heavy = hot.value
        for batch in _gathered(batches):
            for a, b, data, offsets in _batches(*buffer_of(batch.column(1))):
                tokens, limits = _tokens(data, offsets)
                doc = np.repeat(np.arange(b - a), np.diff(limits)).astype(np.uint16)
                before = np.empty_like(tokens)
                before[1:] = tokens[:-1]
                before[limits[:-1]] = BEGIN
                shard = ((tokens >> np.uint64(40)) % np.uint64(shards)).astype(np.int32)
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
                    often = heavy[at] == tokens
                    shard[often] = _spread(tokens[often], before[often], shards)
                # equal tokens of a shard need only lie together, mostly
                order = np.argsort(shard.astype(np.uint64) << np.uint64(40) | tokens >> np.uint64(24)).astype(np.int32)
                tokens, doc, shard = tokens[order], doc[order], shard[order]
                context = before[order] >> _CONTEXT
                del order, before
                training = np.flatnonzero(np.asarray(batch.column(2).slice(a, b - a).to_pylist(), bool)).astype(np.uint16)
                cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
                rows = []
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    fresh = np.flatnonzero(np.concatenate([[True], tokens[x + 1 : y] != tokens[x : y - 1], [True]]))
                    high, low = (context[x:y] >> np.uint64(32)).astype(np.uint8), context[x:y].astype(np.uint32)
                    rows.append(pack([
                        tokens[x:y][fresh[:-1]], np.diff(fresh).astype(np.uint16) if np.diff(fresh).max() < 65536 else np.diff(fresh),
                        low.view(np.uint16), np.pad(high, (0, len(high) % 2)).view(np.uint16), doc[x:y], training,
                    ]))
                number = next(serial)
                shard_of = [-1, *shard[cuts[:-1]].tolist()]
                n = len(shard_of)
                lead = [part] + [-1] * (n - 1)
                lengths = np.diff(limits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(shard_of, pa.int32()), pa.array(lead, pa.int32()),
                        pa.array([lengths.astype(np.int64).tobytes(), *rows], pa.binary()),
                        pa.array([batch.column(0).slice(a, b - a).to_pylist()] + [None] * (n - 1), pa.list_(batch.schema.types[0])),
                        pa.array([batch.column(2).slice(a, b - a).to_pylist()] + [None] * (n - 1), pa.list_(pa.bool_())),
                    ],
                    ["part", "serial", "shard", "lead", "tokens", "ids", "training"],
                )

    return run


def _unpacked(blob):
    words, counts, low, high, doc, training = unpack(blob)
    of = np.repeat(np.arange(len(words), dtype=np.int32), counts)
    context = low.view(np.uint32).astype(np.uint64) | high.view(np.uint8)[: len(of)].astype(np.uint64) << np.uint64(32)
    learns = np.zeros(65536, bool)
    learns[training] = True
    return words, of, context, doc, learns[doc]


def build_trie(words: np.ndarray, of: np.ndarray, contexts: np.ndarray, counts: np.ndarray, total: int, distinct: int, prior: float):
    """Trie of the gains of the bigrams (``words[of]``, context) seen in training, which repeat; ``counts`` are the words'."""
    key, seen = np.unique(of.astype(np.uint64) << np.uint64(NgramTrie.CONTEXT_BITS) | contexts, return_counts=True)
    owner = (key >> np.uint64(NgramTrie.CONTEXT_BITS)).astype(np.int64)
    share = (counts + 0.5) / (total + 0.5 * (distinct + 1))
    gains = np.log10(1 + seen / (prior * share[owner]))
    starts = np.searchsorted(owner, np.arange(len(words) + 1))
    return NgramTrie.build(words, starts, key & np.uint64((1 << NgramTrie.CONTEXT_BITS) - 1), gains)


def _scorer(total: int, distinct: int, prior: float, hot):
    def run(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() < 0:  # ids of batches pass
            return table.select(["part", "serial", "tokens", "ids", "training"]).append_column("sums", pa.nulls(len(table), pa.binary()))
        heavy, heavy_counts = hot.value
        # Twice over the blobs: once for the words, once into arrays of the final size.
        blobs = [np.frombuffer(b, np.uint8) for b in table["tokens"].combine_chunks().to_numpy(zero_copy_only=False)]
        words = np.unique(np.concatenate([unpack(b)[0] for b in blobs]))
        lengths = [len(unpack(b)[4]) for b in blobs]
        of, context = np.empty(sum(lengths), np.int32), np.empty(sum(lengths), np.uint64)
        learns, docs_of, at = np.empty(len(of), bool), np.empty(len(of), np.uint16), 0
        for blob, n in zip(blobs, lengths, strict=True):
            own, mine, contexts, doc, learning = _unpacked(blob)
            of[at : at + n] = np.searchsorted(words, own)[mine]
            context[at : at + n], docs_of[at : at + n], learns[at : at + n] = contexts, doc, learning
            at += n
        counts = np.bincount(of[learns], minlength=len(words))
        if len(heavy):  # a heavy word has only some of its tokens here
            place = np.minimum(np.searchsorted(heavy, words), len(heavy) - 1)
            counts = np.where(heavy[place] == words, heavy_counts[place], counts)
        # One trie per range of words, so that what building and asking need stays small.
        gains = np.zeros(len(of))
        for low in range(0, len(words), max(1, -(-len(words) // PARTS))):
            high = min(len(words), low + -(-len(words) // PARTS))
            some = np.flatnonzero((of >= low) & (of < high))
            own, learnt = of[some] - low, learns[some]
            trie = NgramTrie(build_trie(words[low:high], own[learnt], context[some[learnt]], counts[low:high], total, distinct, prior))
            gains[some] = trie.gain(words[low:high], own, context[some])
        base = np.log10(counts + 0.5)
        # as a token, and as the context of the next token; the end is no context
        alone = base - np.where(words == END, 0.0, np.log10(counts + prior))
        out, begin = [], 0
        for n in lengths:
            own, doc, gain = (x[begin : begin + n] for x in (of, docs_of, gains))
            begin += n
            docs, at = np.unique(doc, return_inverse=True)
            known = np.bincount(at, counts[own] > 0)
            known = known.astype(np.uint16 if known.max() < 65536 else np.int64)
            out.append(pack([docs, np.bincount(at, base[own]), np.bincount(at, alone[own] + gain), known]))
        empty = [pa.nulls(len(out), table.schema.field(c).type) for c in ("tokens", "ids", "training")]
        return pa.table([table["part"], table["serial"], *empty, pa.array(out, pa.binary())], ["part", "serial", "tokens", "ids", "training", "sums"])

    return run


def _finisher(total: int, distinct: int, prior: float, documents: int, kind: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        kinds = table["ids"].is_valid().to_numpy()
        row = int(np.flatnonzero(kinds)[0])
        lengths = np.frombuffer(table["tokens"][row].as_py(), np.int64)
        sums = np.zeros((3, len(lengths)))
        for i in np.flatnonzero(~kinds).tolist():
            docs, *parts = unpack(table["sums"][i].as_py())
            for j in range(3):
                sums[j, docs] += parts[j]
        norm = np.log10(total + 0.5 * (distinct + 1))
        score = sums[1] - lengths * norm + lengths * np.log10(prior) - np.log10(documents + prior)
        return pa.table({
            "doc_id": pa.array(table["ids"][row].as_py(), kind),
            "training": pa.array(table["training"][row].as_py(), pa.bool_()),
            "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.rint(sums[2]).astype(np.int64)),
            "base_score": sums[0] - lengths * norm,
            "score": score,
        })

    return run


def score_documents(docs: DataFrame, training, text: str = "text", prior: float = PRIOR, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``doc_id, training, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``training`` is a boolean column expression: the rows to learn from (null: no). Tokens
    are the words of other than ASCII white space, A-Z lower-cased, then one end. ``n_known``
    counts tokens seen in training, ``train_tokens`` is N. ``base_score`` is the sum of log10
    p(token), ``score`` that of log10 p(token | token before), the first after a begin.
    Gains are rounded to 1/65535 of a shard's largest. A null text is empty: its one token
    is the end. Repeated rows count and score each; without training rows every token is
    equally likely; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    rows = bounded(docs).select("doc_id", F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    words = write_down(
        rows.where("training").select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    total, distinct = words.table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    documents = rows.where("training").count()
    shards = max(1, total // shard_tokens)
    # At most 4 * shards words.
    heavy = sorted((r["word"] & 0xFFFFFFFFFFFFFFFF, r["n"]) for r in words.table.where(F.col("n") > max(1000, total // (4 * shards))).collect()) if shards > 1 else []
    hot = (np.array([w for w, _ in heavy], np.uint64), np.array([n for _, n in heavy], np.int64))
    discard(spark, words.path)
    shared_words, shared = spark.sparkContext.broadcast(hot[0]), spark.sparkContext.broadcast(hot)
    lists = f"ids array<{kind}>, training array<boolean>"
    packed = rows.mapInArrow(_packer(shards, shared_words), f"part int, serial int, shard int, lead int, tokens binary, {lists}")
    both = packed.groupBy("shard", "lead").applyInArrow(
        _scorer(total, distinct, prior, shared), f"part int, serial int, tokens binary, {lists}, sums binary"
    )
    arrow_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    out = both.groupBy("part", "serial").applyInArrow(
        _finisher(total, distinct, prior, documents, arrow_kind), f"doc_id {kind}, training boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return out.withColumn("train_tokens", F.lit(total).cast("long"))
