from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from shelfwise.llm.mixing import mix_sources, one_period, phases, shares


def plain_period(counts, period):
    """Earliest deadline first over all released blocks, found by looking at every block."""
    blocks = [(-(-(i + 1) * period // n), str(s), i, i * period // n, s) for s, n in counts.items() for i in range(n)]
    out, done = {s: [] for s in counts}, set()
    for slot in range(period):
        due = min(b for b in blocks if b not in done and b[3] <= slot)
        done.add(due)
        out[due[4]].append(slot)
    return out


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 97, "b": 2, "c": 0.001}, {"x": 1}])
def test_less_than_one_block_off(weights):
    counts = shares(weights, 100)
    assert sum(counts.values()) == 100 and min(counts.values()) >= 1
    slots = one_period(counts, 100)
    assert slots == plain_period(counts, 100)
    for s, n in counts.items():
        for t in range(101):
            assert abs(sum(x < t for x in slots[s]) - n * t / 100) < 1


def test_phases_use_every_block_once():
    blocks = {"a": 50, "b": 7, "c": 0, "d": 1}
    plan = phases(blocks, {"a": 3, "b": 3, "c": 1, "d": 1}, 20)
    taken = Counter()
    for p in plan:
        for s in p.slots:
            assert p.first[s] == taken[s]
            taken[s] = p.last[s]
    assert taken == {"a": 50, "b": 7, "d": 1}
    assert sum(p.length for p in plan) == 58


def test_every_row_has_a_place(spark, docs):
    many = docs.select("doc_id", "source").unionByName(spark.range(100, 700).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 's0' ELSE 's1' END AS source"))
    out = mix_sources(many, {"s0": 2, "s1": 1, "s2": 1, None: 1}, block_docs=4, period=40).orderBy("position").collect()
    assert len(out) == many.count() == len({r["position"] for r in out})
    blocks = {}
    for r in out:
        blocks.setdefault(r["slot"], set()).add((r["source"], r["block"]))
        assert r["position"] // 4 == r["slot"]
    assert all(len(x) == 1 for x in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    # In the first phase s0 keeps to its weight of 2 / 5.
    first = [next(iter(blocks[t]))[0] for t in range(2)]
    assert len(set(first)) == 2


def test_columns_errors_and_empty(spark, docs):
    out = mix_sources(docs)
    assert out.columns == [*[c for c in docs.columns if c != "block"], "block", "slot", "position"]
    assert out.count() == docs.count()
    assert mix_sources(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no positive weight"):
        mix_sources(docs, {"s0": 1.0})
    with pytest.raises(ValueError, match="more than 1 sources"):
        mix_sources(docs, max_sources=1)


def slots_of(blocks, weights):
    """Slots of each source's blocks in order, as the plan gives them."""
    out = {s: [] for s in blocks}
    for p in phases(blocks, weights, 1000):
        for s, places in p.slots.items():
            for k in range(p.last[s] - p.first[s]):
                out[s].append(p.start + k // len(places) * p.period + places[k % len(places)])
    return out


def most_off(blocks, weights):
    """The largest distance of any source from its unrounded service, at any slot."""
    order = sorted(blocks, key=lambda s: blocks[s] / weights[s])
    at = np.array([0.0, *(blocks[s] / weights[s] for s in order)])
    served = np.array([sum(min(blocks[s], weights[s] * v) for s in blocks) for v in at])
    virtual = np.interp(np.arange(sum(blocks.values()) + 1), served, at)
    worst = 0.0
    for s, places in slots_of(blocks, weights).items():
        got = np.searchsorted(places, np.arange(len(virtual)))
        worst = max(worst, np.abs(got - np.minimum(blocks[s], weights[s] * virtual)).max())
    return worst


def test_less_than_one_block_off_the_unrounded_weights():
    assert most_off(dict.fromkeys("abc", 10_000), dict.fromkeys("abc", 1.0)) < 1 + 1e-5
    # One source of 400 holds a third of the documents; sizes and weights of the others vary.
    blocks = {f"s{i}": 20 + i * 37 % 60 for i in range(399)}
    blocks["big"] = sum(blocks.values()) // 2
    assert most_off(blocks, {s: n**0.5 for s, n in blocks.items()}) < 1 + 1e-5
    assert most_off(blocks, {s: 1 + i * 7919 % 101 / 7 for i, s in enumerate(blocks)}) < 1 + 1e-5


def test_more_than_a_thousand_sources(spark):
    many = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id < 1500 THEN 'all' ELSE concat('host', id % 1200) END AS source")
    out = mix_sources(many, block_docs=2).collect()
    assert len(out) == 4000 == len({r["position"] for r in out})
    counts = Counter(r["source"] for r in out)
    assert len(counts) == 1201
    slots = slots_of({f"s:{s}": -(-n // 2) for s, n in counts.items()}, {f"s:{s}": n**0.5 for s, n in counts.items()})
    assert all(slots[f"s:{r['source']}"][r["block"]] == r["slot"] for r in out)
