"""Normal equations, half steps and gradient steps against numpy, and trained models against their own equations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.models import bpr, equations, fit_model
from shelfwise.operators.idmaps import id_map, index_interactions
from shelfwise.sources import commits

REG, ALPHA = 0.1, 0.7


@pytest.fixture(scope="module")
def case(spark):
    random = np.random.default_rng(4)
    items = random.normal(size=(12, 3))
    rows = [(u, i, float(random.integers(-1, 4))) for u in range(9) for i in range(12) if random.random() < 0.5]
    rows += [(50, 1, 0.0), (51, 2, -1.0), (52, 99, 3.0)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating float")
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id bigint, vector array<double>")
    return rows, items, ratings, vectors


def sides(rows, items, user):
    left, right, n = items.T @ items, np.zeros(3), 0
    for u, i, r in rows:
        if u == user and i < len(items):
            c, p = ALPHA * abs(r), float(r > 0)
            left = left + c * np.outer(items[i], items[i])
            right = right + p * (1 + c) * items[i]
            n += r > 0
    return left + REG * n * np.eye(3), right, n


@pytest.mark.parametrize("block", [3, 1000])
def test_half_step_solves_the_equations(spark, case, block):
    rows, items, ratings, vectors = case
    got = {r["user_id"]: np.array(r["vector"]) for r in equations.solve_users(ratings, vectors, REG, ALPHA, block).collect()}
    for u in range(9):
        left, right, n = sides(rows, items, u)
        assert (u in got) == bool(n)
        if n:
            assert np.allclose(got[u], np.linalg.solve(left, right))
    assert set(got) <= set(range(9))


def test_residuals_and_losses(spark, case):
    rows, items, ratings, vectors = case
    random = np.random.default_rng(5)
    users = random.normal(size=(9, 3))
    table = spark.createDataFrame([(u, v.tolist()) for u, v in enumerate(users)], "user_id bigint, vector array<double>")
    got = {r["user_id"]: r for r in equations.normal_equation_residuals(ratings, table, vectors, REG, ALPHA).collect()}
    for u in range(9):
        left, right, n = sides(rows, items, u)
        if not n:
            continue
        own = {i: r for v, i, r in rows if v == u}
        loss = REG * n * users[u] @ users[u]
        for i, y in enumerate(items):
            r = own.get(i, 0.0)
            loss += (1 + ALPHA * abs(r)) * ((r > 0) - y @ users[u]) ** 2
        assert got[u]["n_positive"] == n
        assert got[u]["residual"] == pytest.approx(np.linalg.norm(left @ users[u] - right) / np.linalg.norm(right))
        assert got[u]["loss"] == pytest.approx(loss)
    solved = equations.solve_users(ratings, vectors, REG, ALPHA)
    after = equations.normal_equation_residuals(ratings, solved, vectors, REG, ALPHA)
    assert after.agg(F.max("residual")).first()[0] < 1e-12


@pytest.fixture(scope="module")
def tastes(spark):
    rows = [(u, i, 1.0 + (u + i) % 3) for u in range(24) for i in range(16) if (u < 12) == (i < 8) and (u * 7 + i * 3) % 4]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating float").cache()
    return ratings, id_map("user_id", ratings), id_map("item_id", ratings)


def test_als_ends_on_a_half_step_of_users(spark, tastes):
    """Vectors are stored as floats, hence the bound."""
    ratings = tastes[0]
    losses = []
    for iterations in (1, 8):
        model = fit_model("als", *tastes, factors=4, iterations=iterations, regularization=0.05, alpha=2.0)
        found = equations.normal_equation_residuals(ratings, model.user_vectors, model.item_vectors, 0.05, 2.0)
        worst, loss, n = found.agg(F.max("residual"), F.sum("loss"), F.count("*")).first()
        assert n == 24 and worst < 1e-4
        losses.append(loss)
        again = equations.solve_users(ratings, model.item_vectors, 0.05, 2.0).withColumnRenamed("vector", "solved")
        pairs = model.user_vectors.join(again, "user_id").collect()
        assert len(pairs) == 24 and all(np.allclose(r["vector"], r["solved"], atol=1e-4) for r in pairs)
    assert losses[1] < losses[0]


def pairs_of(tastes):
    ratings, users, items = tastes
    return index_interactions(ratings, users, items).select("user_idx", "item_idx")


def test_one_step_lowers_the_loss_and_is_the_gradient(spark, tastes):
    _, users, items = tastes
    triples = bpr.bpr_triples(pairs_of(tastes), 16)
    start = bpr.drawn_vectors(users, bpr.USER, 4).unionByName(bpr.drawn_vectors(items, bpr.ITEM, 4)).cache()
    stepped = bpr.gradient_step(start, triples, 0.5, 0.01)
    vectors = {(r["side"], r["idx"]): np.array(r["vector"]) for r in start.collect()}
    change = {k: (np.zeros(5), 0) for k in vectors}
    for t in triples.collect():
        u, i, j = (bpr.USER, t["user_idx"]), (bpr.ITEM, t["item_idx"]), (bpr.ITEM, t["neg_idx"])
        pull = 1 / (1 + np.exp(vectors[u] @ (vectors[i] - vectors[j])))
        for key, move in ((u, pull * (vectors[i] - vectors[j])), (i, pull * vectors[u]), (j, -pull * vectors[u])):
            change[key] = (change[key][0] + move, change[key][1] + 1)
    for r in stepped.collect():
        key = (r["side"], r["idx"])
        total, n = change[key]
        want = vectors[key] + (0.5 * (total / n - 0.01 * vectors[key]) if n else 0)
        if r["side"] == bpr.USER:
            want[-1] = 1.0
        assert r["n"] == n and np.allclose(r["vector"], want, atol=1e-9)
    losses = [bpr.pairwise_loss(v, triples).first()[0] for v in (start, stepped)]
    assert losses[1] < losses[0]


def vectors_of(table):
    return {(r["side"], r["idx"]): r["vector"] for r in table.collect()}


def test_an_interrupted_training_goes_on(spark, tastes, tmp_path, monkeypatch):
    _, users, items = tastes
    pairs, args = pairs_of(tastes), (4, 0.1, 0.01)
    whole = vectors_of(bpr.train_vectors(pairs, users, items, *args, 5).table)
    ledger, ran, real = str(tmp_path / "ledger"), [], bpr._epoch

    def counted(vectors, positives, n_items, epoch, *rest):
        if epoch == 3 and 3 not in ran:
            ran.append(3)
            raise RuntimeError("lost")
        ran.append(epoch)
        return real(vectors, positives, n_items, epoch, *rest)

    monkeypatch.setattr(bpr, "_epoch", counted)
    with pytest.raises(RuntimeError):
        bpr.train_vectors(pairs, users, items, *args, 5, ledger=ledger)
    # rows in another order are the same run
    again = bpr.train_vectors(pairs.orderBy(F.rand(3)), users, items, *args, 5, ledger=ledger)
    assert ran == [0, 1, 2, 3, 3, 4]
    assert vectors_of(again.table) == whole
    assert vectors_of(bpr.train_vectors(pairs, users, items, *args, 5, ledger=ledger).table) == whole
    assert ran == [0, 1, 2, 3, 3, 4]
    bpr.train_vectors(pairs, users, items, *args, 6, ledger=ledger)
    assert ran[6:] == [5]
    bpr.train_vectors(pairs.where("user_idx > 0"), users, items, *args, 1, ledger=ledger)
    assert ran[7:] == [0]
    (run,) = {p.name for p in (tmp_path / "ledger").iterdir() if len(commits.entries(spark, str(p))) > 2}
    assert [e.facts["epochs"] for e in commits.entries(spark, f"{ledger}/{run}")] == [0, 1, 2, 3, 4, 5, 6]
