from __future__ import annotations

import random

import numpy as np
import pytest

from shelfwise.llm import near_dedup
from shelfwise.llm.setsketch import REGISTERS, band_keys, band_shape, may_reach, sketch


def shingles(text, n):
    w = [x.lower() for x in (text or "").split()]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain(rows, n, per_cent):
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= per_cent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in sets}


def group(seed, n, size, edits):
    """Copies of one text, each with up to ``edits`` words changed."""
    r = random.Random(seed)
    base = [f"t{seed}w{r.randrange(500)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(size)] = f"z{r.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_sketch_estimates_similarity():
    random_ = np.random.default_rng(1)
    for share in (0.3, 0.85, 0.95):
        both = random_.integers(1, 1 << 63, int(2000 * share), dtype=np.uint64)
        rest = random_.integers(1, 1 << 63, 2000 - len(both), dtype=np.uint64)
        a, b = np.concatenate([both, rest[::2]]), np.concatenate([both, rest[1::2]])
        regs = sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        fits, likely = may_reach([(regs[0] > regs[1]).sum()], [(regs[0] < regs[1]).sum()], REGISTERS, [len(a)], [len(b)], 0.85)
        assert abs(likely[0] - len(both) / 2000) < 0.1
        assert fits[0] == (share >= 0.85)
        union = sketch(np.unique(np.concatenate([a, b])), np.array([0, len(np.unique(np.concatenate([a, b])))]))
        assert (union[0] == np.maximum(regs[0], regs[1])).all()


def test_bands_miss_next_to_nothing():
    for similarity in (0.8, 0.85):
        bands, rows = band_shape(similarity)
        assert bands <= 64 and (1 - similarity**rows) ** bands <= 1e-8
    keys = band_keys(sketch(np.arange(1, 50, dtype=np.uint64), np.array([0, 49, 49])), bands, rows)
    assert keys.shape == (2, bands) and len(set(keys[0].tolist())) == bands


@pytest.mark.parametrize("block", [256, 8])
def test_against_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = [t for seed, n, size, edits in ((1, 40, 60, 6), (2, 5, 200, 10), (3, 3, 12, 0), (4, 30, 90, 9)) for t in group(seed, n, size, edits)]
    texts += ["", None, " \n", "one", "One", "two words", texts[0], texts[0].upper()]
    rows = list(enumerate(texts, start=5))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(frame, shingle=3, per_cent=85).collect()}
    assert got == plain(rows, 3, 85)


def test_defined_cases(spark, docs):
    odd = docs.union(docs.where("doc_id = 3").selectExpr("NULL AS doc_id", *docs.columns[1:]))
    out = near_dedup.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[20]["n_shingles"] == by_id[21]["n_shingles"] == 0 and by_id[20]["kept"] and by_id[21]["kept"]
    kept = near_dedup.dedup_documents(odd)
    assert kept.columns == docs.columns and kept.where("doc_id = 24").count() == 2
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
