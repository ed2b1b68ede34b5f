from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm.quality import best_quantile, fit_ranker, held_out, score_quality


def corpus(spark, n=240):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8))) for _ in range(r.randint(3, 60))]
        text = " ".join(words).capitalize() + "." if good else " ".join(w.upper() + r.choice(["!!", "###", "$$"]) for w in words)
        rows.append((i, text))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    ranker = fit_ranker(docs, labels.where(~held_out()))
    scored = score_quality(docs, ranker).join(labels, "doc_id").where(held_out()).collect()
    assert len(scored) > 20
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)


def test_defined_cases(spark, docs):
    train, labels = corpus(spark, 80)
    ranker = fit_ranker(train, labels.union(spark.createDataFrame([(None, 1), (3, None), (5, 9)], labels.schema)))
    out = score_quality(docs, ranker)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(r["score"] is not None for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[20] == by_id[21]
    assert score_quality(docs.limit(0), ranker).count() == 0


def test_without_both_labels_all_pass(spark, docs):
    ranker = fit_ranker(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert score_quality(docs, ranker).where("predicted = 0").count() == 0


def test_quantile_with_fewest_errors():
    cut, share = best_quantile([1.0, 2.0, 5.0, 6.0], [False, False, True, True])
    assert (cut, share) == (3.5, 0.5)
    assert best_quantile([1.0, 2.0], [True, True])[0] < 1.0


def test_labels_do_not_reach_scores(spark):
    docs, labels = corpus(spark, 120)
    same = docs.withColumn("doc_id", F.col("doc_id") + 1000)
    ranker = fit_ranker(docs, labels)
    a = sorted(r["score"] for r in score_quality(docs, ranker).collect())
    assert a == sorted(r["score"] for r in score_quality(same, ranker).collect())
