"""External ids to dense indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.hot import hot_ids, join_apart
from shelfwise.operators.interactions import concat
from shelfwise.operators.numbering import number_rows


def distinct_ids(name: str, *frames: DataFrame) -> DataFrame:
    """Set union of an id column over several frames, nulls left out."""
    ids = concat([f.select(F.col(name).cast("long").alias("ext_id")) for f in frames])
    return ids.where(F.col("ext_id").isNotNull()).distinct()


def id_map(name: str, *frames: DataFrame) -> DataFrame:
    """``(ext_id, idx)``: sorted distinct external ids numbered from 0."""
    return number_rows(distinct_ids(name, *frames), ["ext_id"], output="idx")


def index_interactions(
    interactions: DataFrame, user_map: DataFrame, item_map: DataFrame, hot_share: float | None = None
) -> DataFrame:
    """Adds ``user_idx`` and ``item_idx``; rows with an unmapped id are dropped.

    External ids stay beside the indices. Adaptive execution splits hot ids; with a
    ``hot_share`` ids of more than that share of the rows are found in one pass, and their
    rows get indices where they are.
    """
    users = user_map.select(F.col("ext_id").alias("user_id"), F.col("idx").alias("user_idx"))
    items = item_map.select(F.col("ext_id").alias("item_id"), F.col("idx").alias("item_idx"))
    if hot_share is None:
        return interactions.join(items, "item_id").join(users, "user_id")
    hot = {name: hot_ids(interactions, name, hot_share).select(F.col("id").alias(name)) for name in ("item_id", "user_id")}
    return join_apart(join_apart(interactions, items, ["item_id"], hot["item_id"]), users, ["user_id"], hot["user_id"])
