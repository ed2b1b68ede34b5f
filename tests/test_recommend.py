import random

import numpy as np
import pytest
from helpers import as_set
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from shelfwise.operators import evaluate as ev
from shelfwise.operators import ratings, recommend

SCORES = "user_id bigint, item_id bigint, score double"


def test_top_n_breaks_ties_by_id(spark):
    rows = [(1, i, 1.0) for i in (5, 3, 9)] + [(1, 7, 2.0), (2, 1, 0.0)]
    got = recommend.top_n(spark.createDataFrame(rows, SCORES), 3)
    assert as_set(got) == {(1, 1, 7, 2.0), (1, 2, 3, 1.0), (1, 3, 5, 1.0), (2, 1, 1, 0.0)}


def test_top_n_is_cut_before_the_shuffle(spark):
    plan = recommend.top_n(spark.createDataFrame([(1, 1, 1.0)], SCORES), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")


def vectors(spark, name, n, width=5, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.integers(-3, 4, (n, width)).astype(float)
    rows = [(i * 3 - 10, v.tolist()) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, f"{name} bigint, vector array<double>"), {k: np.array(v) for k, v in rows}


@pytest.mark.parametrize("cell_rows", [None, 16])
def test_dot_top_n_against_brute_force(spark, cell_rows):
    """Integer vectors tie often; the lower id must win across grid cells too."""
    users, u = vectors(spark, "user_id", 40)
    items, v = vectors(spark, "item_id", 70, seed=2)
    got = as_set(recommend.dot_top_n(users, items, 6, cell_rows=cell_rows), "user_id", "rank", "item_id")
    want = set()
    for uid, uv in u.items():
        best = sorted(v, key=lambda i: (-float(uv @ v[i]), i))[:6]
        want |= {(uid, rank, i) for rank, i in enumerate(best, 1)}
    assert got == want


def test_dot_top_n_with_few_items(spark):
    users, _ = vectors(spark, "user_id", 3)
    items, _ = vectors(spark, "item_id", 2, seed=2)
    assert recommend.dot_top_n(users, items, 10).count() == 6


def test_fallback(spark):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id bigint")
    known = spark.createDataFrame([(1,), (4,), (9,)], "ext_id bigint")
    mine = spark.createDataFrame(
        [(1, 1, 50, 0.3), (9, 1, 60, 0.2), (2, 1, 70, 0.1)], "user_id bigint, rank int, item_id bigint, score double"
    )
    popular = ratings.top_items(spark.createDataFrame([(8, 2.0), (6, 2.0), (7, 5.0)], "item_id bigint, score double"), 2)
    got = recommend.with_fallback(users, mine, popular, known)
    # User 4 is known but has no list.
    assert as_set(got) == {(1, 1, 50, 0.3)} | {(u, r, i, s) for u in (2, 3, 4) for r, i, s in ((1, 7, 5.0), (2, 6, 2.0))}
    assert as_set(recommend.cold_users(users, known)) == {(2,), (3,)}
    ranked = recommend.by_position(popular, 2)
    assert as_set(ranked, "item_id", "score") == {(7, 2.0), (6, 1.0)}


def test_norms_skip_blocks(spark):
    rng = np.random.default_rng(8)
    things = rng.normal(size=(120, 6)) * np.geomspace(20, 0.01, 120)[:, None]
    asked = rng.normal(size=(30, 6))
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "user_id bigint, vector array<double>")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(things)], "item_id bigint, vector array<double>")
    got = {(r["user_id"], r["rank"]): r["item_id"] for r in recommend.dot_top_n(users, items, 3, cell_rows=20).collect()}
    want = np.argsort(-(asked @ things.T), axis=1)[:, :3]
    assert got == {(u, r + 1): int(want[u, r]) for u in range(30) for r in range(3)}
    _, tops, cells = recommend._item_blocks(items, 6, 20)
    assert sum(cells) >= 6 and tops == sorted(tops, reverse=True)
    # A user whose third best of the first block is out of reach for the others sees no other block.
    seen = spark.createDataFrame([(1.0, tops[1] * 1.5), (1.0, None), (1.0, tops[3] * 0.9)], "norm double, least double")
    open_ = [r[0] for r in seen.select(recommend.reachable_blocks("least", "norm", tops)).collect()]
    assert open_ == [[], [1, 2, 3, 4, 5], [1, 2, 3]]


def test_equal_norms_share_a_block(spark):
    items = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(50)], "item_id bigint, vector array<double>")
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "user_id bigint, vector array<double>")
    got = {r["user_id"]: [] for r in users.collect()}
    for r in recommend.dot_top_n(users, items, 4, cell_rows=7).orderBy("rank").collect():
        got[r["user_id"]].append(r["item_id"])
    assert got == {1: [0, 1, 2, 3], 2: [1, 3, 5, 7]}


def test_popular_list_over_all_items(spark):
    scores = spark.createDataFrame([(8, 2.0), (6, 2.0), (99, 9.0)], "item_id bigint, score double")
    items = spark.createDataFrame([(5,), (6,), (7,), (8,)], "item_id bigint")
    assert as_set(ratings.top_items(scores, 3, items)) == {(1, 6, 2.0), (2, 8, 2.0), (3, 5, 0.0)}
    assert ratings.top_items(scores, 9, items).count() == 4


def test_vectors_must_be_whole(spark):
    good = spark.createDataFrame([(1, [1.0, 2.0])], "item_id bigint, vector array<double>")
    for bad in (None, [1.0, 2.0, 3.0][:1], [1.0, None]):
        users = spark.createDataFrame([(7, [0.5, 0.5]), (8, bad)], "user_id bigint, vector array<double>")
        with pytest.raises(Exception, match="user_id 8"):
            recommend.dot_top_n(users, good, 1).collect()


def test_fallback_without_items_is_empty(spark):
    users = spark.createDataFrame([(1,)], "user_id bigint")
    nothing = ratings.top_items(spark.createDataFrame([], "item_id bigint, score double"), 5)
    assert recommend.popular_lists(users, nothing).isEmpty()


def test_no_cross_join_in_fallback(spark):
    users = spark.range(5).select(F.col("id").alias("user_id"))
    popular = ratings.top_items(spark.createDataFrame([(8, 2.0)], "item_id bigint, score double"), 2)
    text = recommend.popular_lists(users, popular)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def random_case(seed=5):
    rng = random.Random(seed)
    preds = {u: rng.sample(range(30), rng.randint(1, 12)) for u in range(8)}
    truth = {u: set(rng.sample(range(30), rng.randint(1, 9))) for u in range(3, 12)}
    return preds, truth


def frames(spark, preds, truth):
    p = [(u, r, i) for u, items in preds.items() for r, i in enumerate(items, 1)]
    t = [(u, i) for u, items in truth.items() for i in items]
    return (
        spark.createDataFrame(p, "user_id bigint, rank int, item_id bigint"),
        spark.createDataFrame(t + t[:4], "user_id bigint, item_id bigint"),
    )


def test_metrics_against_direct_sums(spark):
    preds, truth = random_case()
    got = {r["metric"]: r["value"] for r in ev.evaluate(*frames(spark, preds, truth), [1, 3, 10]).collect()}
    users = sorted(set(preds) & set(truth))
    for k in (1, 3, 10):
        recall = [len(set(preds[u][:k]) & truth[u]) / len(truth[u]) for u in users]
        ndcg = []
        for u in users:
            dcg = sum(1 / np.log2(i + 2) for i, item in enumerate(preds[u][:k]) if item in truth[u])
            ndcg.append(dcg / sum(1 / np.log2(i + 2) for i in range(min(k, len(truth[u])))))
        assert got[f"recall_at_{k}"] == pytest.approx(np.mean(recall))
        assert got[f"ndcg_at_{k}"] == pytest.approx(np.mean(ndcg))


def test_metrics_against_mllib(spark):
    preds, truth = random_case(9)
    users = sorted(set(preds) & set(truth))
    pairs = spark.createDataFrame(
        [([float(i) for i in preds[u]], [float(i) for i in truth[u]]) for u in users],
        "prediction array<double>, label array<double>",
    )
    got = {r["metric"]: r["value"] for r in ev.evaluate(*frames(spark, preds, truth), [2, 5]).collect()}
    for k in (2, 5):
        for name in ("recallAtK", "ndcgAtK"):
            theirs = RankingEvaluator(predictionCol="prediction", labelCol="label", metricName=name, k=k).evaluate(pairs)
            assert got[f"{name[:-3]}_at_{k}"] == pytest.approx(theirs)


def test_metrics_without_users(spark):
    preds, truth = frames(spark, {1: [3]}, {2: {3}})
    assert as_set(ev.evaluate(preds, truth, [5])) == {("recall_at_5", 0.0), ("ndcg_at_5", 0.0)}
