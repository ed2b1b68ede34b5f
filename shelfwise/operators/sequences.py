"""Training views: enriched interactions, user histories, padding and batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expressions import coerce_value, lenient_day, lenient_label, shard_of
from shelfwise.operators.hot import hot_ids, join_apart
from shelfwise.operators.idmaps import index_interactions
from shelfwise.operators.numbering import number_rows
from shelfwise.operators.splits import BROADCAST_USERS

# A user with more rows than this is processed in blocks of this many.
HISTORY_BLOCK = 1_000_000


def training_view(
    interactions: DataFrame,
    items: DataFrame | None = None,
    item_columns: Sequence[str] = (),
    users: DataFrame | None = None,
    user_columns: Sequence[str] = (),
    hot_share: float | None = None,
) -> DataFrame:
    """Interactions beside the configured item and user columns.

    Feature tables have one row per id. Whether one is small enough to broadcast is left
    to the size Spark measures; otherwise adaptive execution splits a hot id, or, with a
    ``hot_share``, ids of more than that share of the rows meet copies of their feature row.
    """

    def beside(view: DataFrame, table: DataFrame, name: str) -> DataFrame:
        if hot_share is None:
            return view.join(table, name, "left")
        hot = hot_ids(interactions, name, hot_share).select(F.col("id").alias(name))
        return join_apart(view, table, [name], hot, "left")

    view = interactions
    if items is not None and item_columns:
        view = beside(view, items.select("item_id", *item_columns), "item_id")
    if users is not None and user_columns:
        view = beside(view, users.select("user_id", *user_columns), "user_id")
    return view


def positive_view(view: DataFrame, label: str = "target", time: str = "date") -> DataFrame:
    """Positive rows ordered by user and time; item breaks ties."""
    return view.where(F.col(label) > 0).orderBy("user_id", time, "item_id")


def _last_items(window: Window, length: int) -> dict[str, Column]:
    items = F.collect_list("item_idx").over(window.rowsBetween(-length, -1))
    return {"item_id_list": items, "item_length": F.size(items)}


def heavy_users(interactions: DataFrame, block: int = HISTORY_BLOCK, user: str = "user_id") -> DataFrame:
    """Users with more than ``block`` rows; at most (all rows / ``block``) of them."""
    return interactions.groupBy(user).agg(F.count("*").alias("_n")).where(F.col("_n") > block).select(user)


def heavy_indices(interactions: DataFrame, user_map: DataFrame, block: int = HISTORY_BLOCK) -> DataFrame:
    """``user_idx`` of the users with more than ``block`` rows, counted before any join."""
    heavy = heavy_users(interactions, block)
    return heavy.join(user_map, F.col("user_id") == F.col("ext_id")).select(F.col("idx").alias("user_idx"))


def user_history(
    interactions: DataFrame,
    length: int = 50,
    time: str = "date",
    block: int = HISTORY_BLOCK,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Adds the user's last ``length`` item indices before each row, and how many there are.

    Rows are ordered by (time, item index) and are expected to be unique by (user, time,
    item), as interaction features are. Users with at most ``block`` rows are one window
    each. A larger user is cut into consecutive blocks, each given the ``length`` rows
    before it, so no task holds a whole hot user and the histories stay exact. Give
    ``heavy(user_idx)`` where the large users can be told more cheaply than by counting
    ``interactions``.
    """
    order = [time, "item_idx"]
    hot = heavy_users(interactions, block, "user_idx") if heavy is None else heavy
    plain = Window.partitionBy("user_idx").orderBy(*order)
    n_hot = hot.count()
    if not n_hot:
        return interactions.withColumns(_last_items(plain, length))

    if n_hot <= BROADCAST_USERS:
        hot = F.broadcast(hot)
    usual = interactions.join(hot, "user_idx", "left_anti").withColumns(_last_items(plain, length))
    large = _blocked_history(interactions.join(hot, "user_idx", "left_semi"), order, length, block)
    return usual.unionByName(large).select(*interactions.columns, "item_id_list", "item_length")


def _blocked_history(rows: DataFrame, order: list[str], length: int, block: int) -> DataFrame:
    block = max(block, length)
    columns = rows.columns
    numbered = number_rows(rows, order, within=["user_idx"], output="_pos")
    own = F.floor(F.col("_pos") / block)
    # The last rows of a block are also shown to the next one.
    shown_to = F.when(F.col("_pos") % block >= block - length, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(shown_to))
    window = Window.partitionBy("user_idx", "_block").orderBy("_pos")
    done = spread.withColumns(_last_items(window, length)).where(F.col("_block") == F.col("_own"))
    return done.select(*columns, "item_id_list", "item_length")


def pad_left(sequence: str | Column, width: int, shift: int = 1, kind: str = "long") -> Column:
    """Fixed-width sequence with zeros on the left; null is an empty sequence.

    Indices (``kind`` an integer type) move up by ``shift`` so that 0 only means padding;
    values of a ``float`` or ``double`` sequence stay as they are. An over-long sequence
    keeps its most recent entries.
    """
    if kind in ("float", "double"):
        shift = 0
    col = F.coalesce(F.col(sequence) if isinstance(sequence, str) else sequence, F.array().cast(f"array<{kind}>"))
    kept = F.slice(col, F.greatest(F.size(col) - width + 1, F.lit(1)), F.lit(width))
    moved = F.transform(kept, lambda v: (v + shift).cast(kind))
    zeros = F.array_repeat(F.lit(0).cast(kind), F.greatest(F.lit(width) - F.size(col), F.lit(0)))
    return F.concat(zeros, moved)


def with_batches(
    interactions: DataFrame, shards: int, batch_size: int, time: str = "date"
) -> DataFrame:
    """Adds ``shard`` and ``batch``: ordered slices of ``batch_size`` rows inside a shard."""
    sharded = interactions.withColumn("shard", shard_of("user_id", shards))
    numbered = number_rows(sharded, ["user_id", time, "item_id"], within=["shard"], output="_pos")
    return numbered.withColumn("batch", F.floor(F.col("_pos") / batch_size)).drop("_pos")


def sequence_training_view(
    features: DataFrame,
    user_map: DataFrame,
    item_map: DataFrame,
    kinds: Mapping[str, str],
    items: DataFrame | None = None,
    item_columns: Sequence[str] = (),
    users: DataFrame | None = None,
    user_columns: Sequence[str] = (),
    length: int = 50,
    label: str = "target",
    time: str = "date",
    block: int = HISTORY_BLOCK,
) -> DataFrame:
    """Model-ready rows: indices, label, day, history and coerced feature columns.

    Histories are built on the narrow interaction rows; wide item columns join last.
    """
    indexed = index_interactions(features, user_map, item_map)
    dated = indexed.withColumns({label: lenient_label(label), time: lenient_day(indexed, time)})
    # Indexing only drops rows, so a user not heavy before it is not heavy after it.
    told = user_history(dated, length, time, block, heavy_indices(features, user_map, block))
    view = training_view(told, items, item_columns, users, user_columns)
    coerced = {name: coerce_value(view, name, kind) for name, kind in kinds.items()}
    return view.withColumns(coerced) if coerced else view
