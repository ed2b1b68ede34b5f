from __future__ import annotations

from collections import Counter

import numpy as np

from shelfwise.llm import perfect_hash
from shelfwise.llm.line_dedup import dedup_lines


def plain(rows, at_least):
    """Lines by document, without any hash."""

    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    lines = {n: (t or "").split("\n") for n, t in rows}
    held = Counter(k for each in lines.values() for k in {key(x) for x in each} if k)
    often = {k for k, n in held.items() if n >= at_least}
    return {n: "\n".join(x for x in each if key(x) not in often) for n, each in lines.items()}


def test_perfect_hash_is_minimal_and_tells_strangers():
    random = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        first, second = (random.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        counts = np.arange(n) % 300
        packed = __import__("pickle").loads(perfect_hash.build(first, second, counts))
        assert len(packed[1]) == n
        assert (perfect_hash.counts_of(packed, first, second) == counts).all()
        assert not perfect_hash.counts_of(packed, first, second + np.uint64(1)).any()


def test_against_plain_version(spark, docs):
    rows = [(n, r["doc_id"], r["text"]) for n, r in enumerate(docs.collect())]
    frame = spark.createDataFrame(rows, "n int, doc_id bigint, text string")
    for at_least, wave in ((2, 64 << 20), (10, 64 << 20), (2, 64)):
        got = {r["n"]: r["text"] for r in dedup_lines(frame, min_docs=at_least, wave_bytes=wave).collect()}
        assert got == plain([(n, t) for n, _, t in rows], at_least)


def test_counts_and_columns(spark, docs):
    out = dedup_lines(docs)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert (by_id[3]["n_lines"], by_id[3]["n_dropped"]) == (3, 1)
    assert (by_id[21]["n_lines"], by_id[21]["n_dropped"], by_id[21]["text"]) == (1, 0, "")
    assert dedup_lines(docs.limit(0)).count() == 0


def test_many_shards(spark, monkeypatch):
    from shelfwise.llm import line_dedup

    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rows = [(d, "\n".join(f"line {k}" for k in range(d % 4, 40, 3))) for d in range(30)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in dedup_lines(frame, min_docs=9, wave_bytes=200).collect()}
    assert got == plain(rows, 9)
