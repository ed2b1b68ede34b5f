from __future__ import annotations

import numpy as np
import pytest

from shelfwise.llm import neighbours
from shelfwise.llm.kmeans_tree import best_bin_first, grow, leaf_numbers
from shelfwise.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, leaf int"


def points(n=600, d=12, seed=2):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(10, d)) * 3
    return (centres[random.integers(0, 10, n)] + random.normal(size=(n, d))).astype(np.float32)


def test_tree_deals_out_all_points():
    x = points().astype(float)
    tree = grow(x, 20)
    leaf = leaf_numbers(tree, x)
    assert set(leaf) <= set(range(tree.leaves)) and tree.leaves > 10
    for q in x[:20]:
        order = list(best_bin_first(tree, q))
        assert sorted(order) == list(range(tree.leaves))


@pytest.mark.parametrize("group", [8192, 40])
def test_recall_and_exact_scores(spark, monkeypatch, group):
    monkeypatch.setattr(neighbours, "GROUP_ROWS", group)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 7)
    x = points()
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA)
    got = nearest_neighbours(frame, frame.where("vec_id % 10 = 0"), k=5, leaf_rows=20).collect()
    y = x.astype(np.float64)
    hits = 0
    for q in range(0, 600, 10):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        score = (y * y[q]).sum(1)
        assert all(r["score"] == score[r["vec_id"]] for r in mine)
        score[q] = -np.inf
        hits += len({r["vec_id"] for r in mine} & set(np.argsort(-score)[:5].tolist()))
    assert hits / 300 >= 0.9


def test_ties_and_useless_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(40, [0.0, 0.0]), (41, None), (42, [1.0, None]), (43, [float("nan"), 1.0]), (None, [1.0, 1.0]), (44, [1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = nearest_neighbours(frame, frame, k=3, leaf_rows=4).collect()
    assert {r["query_id"] for r in got} == set(range(30))
    for q in (0, 1, 29):
        want = [i for i in range(30) if i != q][:3]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [0.5, 0.5], 0)], SCHEMA)
    assert [(r["query_id"], r["vec_id"]) for r in nearest_neighbours(frame, frame).orderBy("query_id").collect()] == [(1, 2), (2, 1)]
    assert nearest_neighbours(frame.limit(0), frame.limit(0)).count() == 0
    assert nearest_neighbours(frame, frame.limit(0)).count() == 0
