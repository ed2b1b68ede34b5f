"""Rating tables, popularity and validation truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.labels import DELIVERED, Label
from shelfwise.operators.interactions import PAIR, labelled_days


def build_ratings(tracker: DataFrame, orders: DataFrame | None, label: Label) -> DataFrame:
    """``(user_id, item_id, rating)``: positive labels summed over all events of a pair."""
    days = labelled_days(tracker, orders, label).where("label_sum > 0")
    return days.groupBy(*PAIR).agg(F.expr("CAST(sum(label_sum) AS FLOAT) AS rating"))


def binarise(ratings: DataFrame) -> DataFrame:
    """Any positive rating counts as 1."""
    return ratings.withColumn("rating", F.when(F.col("rating") > 0, 1.0).otherwise(0.0).cast("float"))


def popularity_by_weight(ratings: DataFrame) -> DataFrame:
    """Sum of ratings per item."""
    return ratings.groupBy("item_id").agg(F.sum(F.col("rating").cast("double")).alias("score"))


def popularity_by_count(interactions: DataFrame) -> DataFrame:
    """Rows per item."""
    return interactions.groupBy("item_id").agg(F.count("*").cast("double").alias("score"))


def top_items(popularity: DataFrame, n: int, items: DataFrame | None = None) -> DataFrame:
    """``(rank, item_id, score)`` of the ``n`` most popular items; ties go to the lower id.

    Given ``items(item_id)``, exactly these compete, and those without a score have 0, so
    the list is ``min(n, all items)`` long. The limit is a distributed top-n; the window
    that numbers it sees ``n`` rows.
    """
    if items is not None:
        popularity = items.select("item_id").join(popularity, "item_id", "left").fillna(0.0, ["score"])
    best = popularity.orderBy(F.desc("score"), "item_id").limit(n)
    order = Window.orderBy(F.desc("score"), "item_id")
    return best.select(F.row_number().over(order).alias("rank"), "item_id", "score")


def truth_from_orders(orders: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs with a delivered order."""
    return orders.where(F.col("last_status") == DELIVERED).select(*PAIR).distinct()


def truth_from_features(features: DataFrame, label: str = "target") -> DataFrame:
    """Distinct (user, item) pairs with a positive target."""
    return features.where(F.col(label).cast("int") > 0).select(*PAIR).distinct()


def dataset_stats(ratings: DataFrame, users: DataFrame, items: DataFrame, truth: DataFrame) -> DataFrame:
    """Sizes of a prepared dataset, one ``(statistic, value)`` row each."""

    def size(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(F.lit(name).alias("statistic"), "value")

    parts = [
        size(users, "n_users"),
        size(items, "n_items"),
        size(ratings, "n_positive_pairs"),
        size(truth, "n_truth_pairs"),
        truth.agg(F.count_distinct("user_id").alias("value")).select(
            F.lit("n_valid_users").alias("statistic"), "value"
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
