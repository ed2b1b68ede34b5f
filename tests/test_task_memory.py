"""What a task holds must not grow with users times the length of their lists, nor with whole tables."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import as_set

from shelfwise.operators import cones, recommend
from shelfwise.operators import evaluate as ev
from shelfwise.operators.recommend import popular_lists
from shelfwise.plans.jobs import SplitSettings, judge_popularity

DAY_4, DAY_9 = 1_704_326_400, 1_704_758_400


def test_popular_list_is_judged_without_unfolding_it(spark, clicks, bought):
    judged = judge_popularity(clicks, bought, SplitSettings(DAY_4, DAY_9), "combined", (1, 2))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    # The metrics of the end are unfolded from one row, the list for every user is not.
    assert plan.count("Generate") == 1
    assert {r["metric"] for r in judged.collect()} == {f"{m}_at_{k}" for m in ("recall", "ndcg") for k in (1, 2)}


@pytest.mark.parametrize("listed", [[(1, 10), (2, 12), (3, 11)], [(1, 5)], []])
def test_shared_list_is_judged_like_unfolded_lists(spark, listed):
    truth = spark.createDataFrame([(1, 10), (1, 11), (1, 10), (2, 12), (2, 99), (3, 98), (3, None)], "user_id bigint, item_id bigint")
    popular = spark.createDataFrame([(r, i, 1.0) for r, i in listed], "rank int, item_id bigint, score double")
    unfolded = ev.evaluate(popular_lists(truth.select("user_id").distinct(), popular), truth, [1, 2, 3])
    assert as_set(ev.evaluate_shared(popular, truth, [1, 2, 3])) == as_set(unfolded)


def cell(name, ids, vectors):
    batches = [
        pa.record_batch([pa.array(ids[a : a + 700]), pa.array(list(vectors[a : a + 700]), pa.list_(pa.float32()))], [name, "vector"])
        for a in range(0, len(ids), 700)
    ]
    return pa.Table.from_batches(batches)


def test_cell_keeps_vectors_as_they_came():
    """A worker holds the vectors it got, slices of bounded size, and the lists."""
    random = np.random.default_rng(4)
    users, items = random.normal(size=(600, 64)).astype(np.float32), random.normal(size=(30_000, 64)).astype(np.float32)
    asked, offered = cell("user_id", np.arange(600), users), cell("item_id", np.arange(30_000), items)
    run = recommend._cell_top(10, 64)
    tracemalloc.start()
    got = run(asked, offered)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The items alone would be 15 MB in double precision, their scores for all users 144 MB.
    assert most < 8 * 8 * recommend.SCORE_ENTRIES / 1.5
    scores = users.astype(float) @ items.T.astype(float)
    want = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    assert (got["item_id"].to_numpy().reshape(600, 10) == want).all()
    assert (got["user_id"].to_numpy() == np.repeat(np.arange(600), 10)).all()


@pytest.mark.parametrize("entries", [12, 100, 5000])
def test_slices_change_nothing(monkeypatch, entries):
    """Copies of a vector score alike to the last bit, in slices and cells of any shape."""
    random = np.random.default_rng(6)
    users, base = random.normal(size=(23, 7)).astype(np.float32), random.normal(size=(40, 7)).astype(np.float32)
    items, ids = np.tile(base, (4, 1)), random.permutation(160)
    monkeypatch.setattr(recommend, "SCORE_ENTRIES", entries)
    got = recommend._cell_top(9, 7)(cell("user_id", np.arange(23), users), cell("item_id", ids, items))
    one_by_one = np.cumsum(users.astype(float)[:, None, :] * items.astype(float)[None], axis=2)[:, :, -1]
    order = np.lexsort((np.broadcast_to(ids, one_by_one.shape), -one_by_one), axis=1)[:, :9]
    assert (got["item_id"].to_numpy().reshape(23, 9) == ids[order]).all()
    assert (got["score"].to_numpy().reshape(23, 9) == np.take_along_axis(one_by_one, order, 1)).all()


def test_long_lists_make_small_groups(spark, monkeypatch):
    """The lists that leave a cell are bounded too, whatever the width of the vectors."""
    sizes = []
    monkeypatch.setattr(recommend, "LIST_ENTRIES", 60)
    grouped = recommend.grouped
    monkeypatch.setattr(recommend, "grouped", lambda asked, found, rows: sizes.append(rows) or grouped(asked, found, rows))
    random = np.random.default_rng(2)
    vectors = [(i, v.tolist()) for i, v in enumerate(random.normal(size=(50, 3)))]
    users = spark.createDataFrame(vectors, "user_id bigint, vector array<double>")
    items = spark.createDataFrame(vectors, "item_id bigint, vector array<double>")
    got = recommend.dot_top_n(users, items, 12, cell_rows=20)
    assert got.count() == 600 and sizes == [5]


def test_bounds_are_held_in_pieces(monkeypatch):
    monkeypatch.setattr(cones, "BOUND_ENTRIES", 100)
    batches = [pa.record_batch([pa.array(range(n))], ["x"]) for n in (25, 0, 7)]
    pieces = list(cones._pieces(batches, 10))
    assert [p.num_rows for p in pieces] == [10, 10, 5, 7]
    assert [x for p in pieces for x in p.column(0).to_pylist()] == [*range(25), *range(7)]
