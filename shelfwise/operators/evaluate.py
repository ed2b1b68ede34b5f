"""Ranking metrics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ideal(k: int) -> str:
    """Best possible DCG at ``k`` for a user with ``n_truth`` true items."""
    best = accumulate(1.0 / math.log2(position + 1) for position in range(1, k + 1))
    return f"element_at(array({', '.join(f'{gain!r}D' for gain in best)}), CAST(least(n_truth, {k}) AS INT))"


def user_metrics(predictions: DataFrame, truth: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Recall and NDCG per user that has both predictions and truth.

    Predictions and truth meet in one aggregation by (user, item) and are summed by user;
    both combine on the map side, so a user with very many true items is no hot spot.
    """
    ranked = predictions.selectExpr("user_id", "item_id", "CAST(rank AS INT) AS rank", "0 AS wanted")
    wanted = truth.selectExpr("user_id", "item_id", "CAST(NULL AS INT) AS rank", "1 AS wanted")
    pairs = ranked.unionByName(wanted).groupBy("user_id", "item_id").agg(
        F.expr("min(rank) AS rank"), F.expr("max(wanted) AS wanted")
    )
    return _per_user(pairs, ks, "n_ranked > 0 AND n_truth > 0")


def shared_list_metrics(listed: DataFrame, truth: DataFrame, ks: Sequence[int]) -> DataFrame:
    """:func:`user_metrics` of one list, ``(rank, item_id)``, that every user with truth is shown.

    The list is a top-N and is sent to the true pairs, so it is never unfolded per user;
    what a task holds follows from its pairs. If nothing is listed every user has 0.
    """
    ranks = listed.groupBy(F.col("item_id").alias("_listed")).agg(F.expr("CAST(min(rank) AS INT) AS rank"))
    wanted = truth.select("user_id", "item_id").distinct().withColumn("wanted", F.lit(1))
    pairs = wanted.join(F.broadcast(ranks), F.col("item_id").eqNullSafe(F.col("_listed")), "left")
    return _per_user(pairs, ks, "n_truth > 0")


def _per_user(pairs: DataFrame, ks: Sequence[int], kept: str) -> DataFrame:
    """Metrics of the ``kept`` users from ``(user_id, item_id, rank, wanted)``, one row per pair."""
    sums = ["count(rank) AS n_ranked", "count_if(wanted = 1) AS n_truth"]
    means = []
    for k in ks:
        found = f"wanted = 1 AND rank <= {k}"
        sums.append(f"count_if({found}) AS hits_{k}")
        sums.append(f"sum(CASE WHEN {found} THEN 1D / log2(rank + 1) ELSE 0D END) AS dcg_{k}")
        means.append(f"hits_{k} / n_truth AS recall_at_{k}")
        means.append(f"dcg_{k} / {_ideal(k)} AS ndcg_at_{k}")
    users = pairs.groupBy("user_id").agg(*map(F.expr, sums)).where(kept)
    return users.selectExpr("user_id", "n_truth", *means)


def evaluate(predictions: DataFrame, truth: DataFrame, ks: Sequence[int]) -> DataFrame:
    """``(metric, value)``: recall@k and NDCG@k averaged over users; 0 without users."""
    return _averages(user_metrics(predictions, truth, ks), ks)


def evaluate_shared(listed: DataFrame, truth: DataFrame, ks: Sequence[int]) -> DataFrame:
    """:func:`evaluate` of one list that every user with truth is shown."""
    return _averages(shared_list_metrics(listed, truth, ks), ks)


def _averages(users: DataFrame, ks: Sequence[int]) -> DataFrame:
    names = [f"{m}_at_{k}" for k in ks for m in ("recall", "ndcg")]
    means = users.agg(*[F.expr(f"coalesce(avg({n}), 0D) AS {n}") for n in names])
    rows = ", ".join(f"named_struct('metric', '{n}', 'value', {n})" for n in names)
    return means.selectExpr(f"inline(array({rows}))")
