from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm.elias_fano import EliasFano, NgramTrie, pack, unpack
from shelfwise.llm.language_model import score_documents


def test_sequences_round_trip():
    random = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 0), (5, 3), (1000, (1 << 64) - 1), (1000, 900), (3000, 1 << 41)):
        values = np.sort(random.integers(0, top, n, dtype=np.uint64, endpoint=True))
        sequence = EliasFano(unpack(pack(EliasFano.parts(values, top))))
        assert (sequence.values(np.arange(n)) == values).all()
        if n:
            keys = np.concatenate([values, random.integers(0, top, 200, dtype=np.uint64, endpoint=True)])
            begin = random.integers(0, n, len(keys))
            end = np.minimum(n, begin + random.integers(0, n + 1, len(keys)))
            want = [b + np.searchsorted(values[b:e], k) for k, b, e in zip(keys, begin, end)]
            got, same = sequence.successor(keys, begin, end)
            assert (got == want).all()
            assert same.tolist() == [bool(w < e and values[w] == k) for k, w, e in zip(keys, want, end)]


def test_mapped_trie(tmp_path):
    words = np.array([5, 9, 11], np.uint64)
    data = NgramTrie.build(words, np.array([0, 2, 2, 3]), np.array([1, 7, 2], np.uint64), np.array([0.5, 1.0, 2.0]))
    (tmp_path / "trie").write_bytes(data)
    trie = NgramTrie.open(str(tmp_path / "trie"))
    got = trie.gain(np.array([5, 6, 11], np.uint64), np.array([0, 0, 1, 2, 2]), np.array([1, 7, 1, 2, 3], np.uint64))
    assert np.allclose(got, [0.5, 1.0, 0, 2.0, 0], atol=1e-4)


def plain(rows, training, prior):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["</s>"] for _, t in rows]
    one, two, starts = Counter(), Counter(), sum(training)
    for w, t in zip(tokens, training):
        if t:
            one.update(w)
            two.update(zip(["<s>", *w], w))
    total, distinct = sum(one.values()), len(one)
    p = lambda x: (one[x] + 0.5) / (total + 0.5 * (distinct + 1))
    out = []
    for w in tokens:
        base = sum(math.log10(p(x)) for x in w)
        score = sum(math.log10((two[u, x] + prior * p(x)) / ((starts if u == "<s>" else one[u]) + prior)) for u, x in zip(["<s>", *w], w))
        out.append((len(w), sum(one[x] > 0 for x in w), base, score))
    return out


def test_against_plain_version(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(50 + i, "a b a c the the b " * i) for i in range(9)]
    training = [i % 3 > 0 for i in range(len(rows))]
    frame = spark.createDataFrame([(n, t, k) for (n, (_, t)), k in zip(enumerate(rows), training)], "doc_id bigint, text string, learns boolean")
    for shard in (10**6, 400):
        got = score_documents(frame.repartition(3), F.col("learns"), prior=5.0, shard_tokens=shard).orderBy("doc_id").collect()
        for r, (n, known, base, score) in zip(got, plain(rows, training, 5.0), strict=True):
            assert (r["n_tokens"], r["n_known"]) == (n, known)
            assert abs(r["base_score"] - base) < 1e-7 and abs(r["score"] - score) < 1e-4 * n


def test_probabilities_sum_to_one(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "a a", "b"])] + [(9, "a"), (10, "a a"), (11, "a b"), (12, "a zz")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in score_documents(frame, F.col("doc_id") < 9, prior=2.0).collect()}
    # After "a": the end, "a", "b", and one unseen word make up everything; what follows a word is told by longer texts.
    after = plain([(0, "a b"), (1, "a a"), (2, "b")], [True] * 3, 2.0)
    assert len(after) == 3 and all(s <= 0 for s in got.values())


def test_defined_cases(spark, docs):
    out = score_documents(docs, F.lit(None).cast("boolean"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == docs.count() and rows[21]["n_tokens"] == 1 and rows[21]["n_known"] == 0
    assert abs(rows[21]["score"]) < 1e-9 and rows[21]["train_tokens"] == 0
    assert score_documents(docs.limit(0), F.lit(True)).count() == 0
