"""Which blocks of items a user is shown, and that none with a better item is missing."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import as_set

from shelfwise.operators import cones, recommend


def frame(spark, name, vectors, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(vectors)], f"{name} bigint, vector array<double>")


def gathered(seed, groups, each, width=8, noise=0.05):
    """Unit vectors around some directions."""
    random = np.random.default_rng(seed)
    centres = np.random.default_rng(99).normal(size=(groups, width))
    rows = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], each, axis=0) + noise * random.normal(size=(groups * each, width))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def best(users, items, n):
    scores = users @ items.T
    return {(u, r + 1, int(i)) for u, row in enumerate(scores) for r, i in enumerate(np.lexsort((np.arange(len(items)), -row))[:n])}


def test_bounds_hold(spark):
    random = np.random.default_rng(3)
    users = np.concatenate([random.normal(size=(60, 5)), np.zeros((1, 5)), -random.normal(size=(5, 5)) * 100])
    items = np.concatenate([random.normal(size=(200, 5)) * random.gamma(1, size=(200, 1)), np.zeros((3, 5))])
    placed, found = cones.cone_blocks(frame(spark, "item_id", items), 17)
    bounds = found.bounds(users)
    rows = placed.collect()
    assert len(rows) == 203 and all(found.first_cell[r["block"]] <= r["_i"] < found.first_cell[r["block"] + 1] for r in rows)
    for r in rows:
        assert (users @ np.array(r["vector"]) <= bounds[:, r["block"]]).all()


def test_unit_vectors_skip_most_cells(spark):
    users, items = gathered(1, 20, 6), gathered(2, 20, 15)
    asked, offered = frame(spark, "user_id", users), frame(spark, "item_id", items)
    got = as_set(recommend.dot_top_n(asked, offered, 5, cell_rows=15), "user_id", "rank", "item_id")
    assert got == best(users, items, 5)
    _, found = cones.cone_blocks(offered, 15)
    shown = cones.asking(asked, found, 5)
    least = frame_of_least(spark, users, items, 5)
    more = cones.asking(asked, found, 5, shown, least)
    visits = sum(sum(int(found.cells[b]) for b in r["blocks"]) for df in (shown, more) for r in df.collect())
    assert visits < 0.25 * len(users) * found.cells.sum()


def frame_of_least(spark, users, items, n):
    scores = np.sort(users @ items.T, axis=1)[:, -n]
    return spark.createDataFrame([(u, float(s)) for u, s in enumerate(scores)], "user_id bigint, _least double")


@pytest.mark.parametrize("bounds", ["cones", "norms"])
@pytest.mark.parametrize("n", [1, 7, 50])
def test_against_brute_force(spark, bounds, n):
    random = np.random.default_rng(11)
    users, items = random.normal(size=(40, 6)).round(1), random.normal(size=(90, 6)).round(1)
    users[3], items[[5, 6]], items[20:40] = 0, 0, items[20]
    got = recommend.dot_top_n(frame(spark, "user_id", users), frame(spark, "item_id", items), n, cell_rows=9, bounds=bounds)
    scores = np.round(users @ items.T, 9)
    mine = {(r["user_id"], r["rank"]): (r["item_id"], round(r["score"], 9)) for r in got.collect()}
    for u in range(40):
        order = np.sort(scores[u])[::-1][: min(n, 90)]
        assert [mine[u, k + 1][1] for k in range(len(order))] == pytest.approx(order.tolist())
        assert all(scores[u, mine[u, k + 1][0]] == pytest.approx(mine[u, k + 1][1]) for k in range(len(order)))


def test_all_items_zero(spark):
    items = frame(spark, "item_id", np.zeros((30, 3)))
    got = recommend.dot_top_n(frame(spark, "user_id", np.ones((2, 3))), items, 4, cell_rows=10)
    assert as_set(got, "user_id", "item_id", "score") == {(u, i, 0.0) for u in range(2) for i in range(4)}


def test_odd_vectors_are_named(spark):
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)] + [(77, [1.0])], "item_id bigint, vector array<double>")
    users = spark.createDataFrame([(1, [1.0, 0.0])], "user_id bigint, vector array<double>")
    with pytest.raises(Exception, match="item_id 77"):
        recommend.dot_top_n(users, items, 1, cell_rows=3).collect()
    with pytest.raises(ValueError):
        recommend.dot_top_n(users, items, 1, bounds="guess")
