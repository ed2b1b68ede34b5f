"""Per-user top-N: from scores, from vectors, and from popularity for unknown users."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.cones import asking, cone_blocks, grouped, in_cells
from shelfwise.workspace import write_down

# Vector entries per side of a grid cell, list entries that leave it, and scores or converted entries held at a time inside it.
CELL_ENTRIES = 16_000_000
LIST_ENTRIES = 2_000_000
SCORE_ENTRIES = 1_000_000


def top_n(scores: DataFrame, n: int) -> DataFrame:
    """``(user_id, rank, item_id, score)`` of each user's best ``n``; ties go to the lower id.

    The rank filter is applied before the shuffle as well, so a user with very many
    scored items sends at most ``n`` rows per input partition.
    """
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("user_id", "rank", "item_id", "score")


def known_users(users: DataFrame, user_map: DataFrame) -> DataFrame:
    """Users present in the id map."""
    return users.join(user_map.select(F.col("ext_id").alias("user_id")), "user_id", "left_semi")


def cold_users(users: DataFrame, user_map: DataFrame) -> DataFrame:
    """Users absent from the id map."""
    return users.join(user_map.select(F.col("ext_id").alias("user_id")), "user_id", "left_anti")


def popular_lists(users: DataFrame, popular: DataFrame) -> DataFrame:
    """Every user with the same ranked list.

    ``popular`` is a top-N, so it is one array value, computed once and unfolded per user.
    Without popular items there are no rows.
    """
    entries = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    listed = users.select("user_id", popular.agg(entries).scalar().alias("_top"))
    return listed.select("user_id", F.inline("_top"))


def by_position(popular: DataFrame, n: int) -> DataFrame:
    """Popular items scored ``k - position`` instead of by popularity, with k items listed."""
    listed = popular.where(F.col("rank") <= n)
    k = listed.agg(F.count("*")).scalar()
    return listed.withColumn("score", (k - F.col("rank") + 1).cast("double"))


def with_fallback(users: DataFrame, known: DataFrame, popular: DataFrame, user_map: DataFrame) -> DataFrame:
    """Known users keep their lists; every asked user without a list gets the popular one.

    That includes users who are known but have no list. The lists are read once: a user
    left over by the outer join unfolds the popular list, which is one array value.
    """
    columns = ["user_id", "rank", "item_id", "score"]
    asked = users.select("user_id").distinct()
    mine = known.select(*columns).join(known_users(asked, user_map), "user_id", "left_semi")
    entry = F.struct(F.col("rank").cast("int").alias("rank"), "item_id", F.col("score").cast("double").alias("score"))
    same = popular.select(F.col("rank").cast("int").alias("rank"), "item_id", F.col("score").cast("double").alias("score"))
    entries = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    listed = asked.join(mine, "user_id", "left").select(
        "user_id", F.when(F.col("rank").isNotNull(), F.array(entry)).otherwise(same.agg(entries).scalar()).alias("_list")
    )
    return listed.select("user_id", F.inline("_list"))


def _cell_top(n: int, width: int):
    """Best ``n`` items of a grid cell for each of its users, by matrix products of slices of both sides.

    Vectors stay as they came; only the slices at work are converted. A product may differ
    in its last bits with the shape of a slice, so it only finds candidates: their scores
    are summed again in the order of the entries, and equal vectors score alike in all cells.

    The function that runs in the workers refers to nothing in this package, so that they
    need not have it installed.
    """
    entries = SCORE_ENTRIES

    def matrices(table: pa.Table, key: str) -> list[np.ndarray]:
        """The vectors as the batches hold them, without a copy."""
        found = []
        for batch in table.select([key, "vector"]).to_batches():
            vectors = batch.column(1)
            odd = np.flatnonzero(~(vectors.value_lengths().to_numpy(zero_copy_only=False) == width))
            if len(odd):
                raise ValueError(f"{key} {batch.column(0)[int(odd[0])].as_py()} has no vector of {width} entries")
            values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            if np.isnan(values).any():
                bad = int(np.flatnonzero(np.isnan(values).any(1))[0])
                raise ValueError(f"{key} {batch.column(0)[bad].as_py()} has a vector with missing entries")
            found.append(values)
        return found

    def slices(parts: list[np.ndarray], rows: int):
        """First row and vectors of every slice, in double precision."""
        first = 0
        for part in parts:
            for start in range(0, len(part), rows):
                yield first + start, part[start : start + rows].astype(np.float64, copy=False)
            first += len(part)

    def exact(left: np.ndarray, right: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out, step = np.empty(len(rows)), max(1, entries // width)
        for start in range(0, len(rows), step):
            at = slice(start, start + step)
            out[at] = np.cumsum(left[rows[at]] * right[columns[at]], axis=1)[:, -1]
        return out

    def best(users: pa.Table, items: pa.Table) -> pa.Table:
        schema = pa.schema([("user_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])
        if not users.num_rows or not items.num_rows:
            return schema.empty_table()
        user_ids, item_ids = users.column("user_id").to_numpy(), items.column("item_id").to_numpy()
        user_parts, item_parts = matrices(users, "user_id"), matrices(items, "item_id")
        k = min(n, len(item_ids))
        user_step = max(1, min(256, entries // width))
        item_step = max(1, min(entries // user_step, entries // width))
        longest = max(float(np.linalg.norm(part, axis=1).max()) for _, part in slices(item_parts, item_step))
        out_ids, out_scores = np.empty((len(user_ids), k), item_ids.dtype), np.empty((len(user_ids), k))
        for first, left in slices(user_parts, user_step):
            # Neither a product nor a bound taken from products is off by more than this.
            slack = 4 * (width + 1) * np.finfo(float).eps * longest * np.linalg.norm(left, axis=1)
            rows, ids, scores = np.empty(0, np.int64), np.empty(0, item_ids.dtype), np.empty(0)
            least = np.full(len(left), -np.inf)
            for start, right in slices(item_parts, item_step):
                product = left @ right.T
                if len(right) > k and np.isneginf(least).any():
                    least = np.maximum(least, np.partition(product, -k, axis=1)[:, -k])
                row, column = np.divmod(np.flatnonzero(~(product < (least - slack)[:, None])), len(right))
                if not len(row):
                    continue
                rows = np.concatenate([rows, row])
                ids = np.concatenate([ids, item_ids[start + column]])
                scores = np.concatenate([scores, exact(left, right, row, column)])
                # All items at the k-th score compete, so ties fall to the lower id.
                order = np.lexsort((ids, -scores, rows))
                each = np.bincount(rows, minlength=len(left))
                starts = np.cumsum(each) - each
                order = order[np.arange(len(rows)) - np.repeat(starts, each) < k]
                rows, ids, scores = rows[order], ids[order], scores[order]
                full = each >= k
                ends = np.cumsum(np.minimum(each, k)) - 1
                least = np.where(full, scores[np.where(full, ends, 0)], -np.inf)
            out_ids[first : first + len(left)] = ids.reshape(-1, k)
            out_scores[first : first + len(left)] = scores.reshape(-1, k)
        columns = [np.repeat(user_ids, k), out_ids.reshape(-1), out_scores.reshape(-1)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)

    return best


def _size(vectors: DataFrame) -> tuple[int, int]:
    """Rows and vector width."""
    rows, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    return rows, width or 1


def _norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")))


def _item_blocks(items: DataFrame, blocks: int, cell_rows: int) -> tuple[DataFrame, list[float], list[int]]:
    """``items`` with ``_block``, from the greatest norms down, and ``_i``, its cell; norm bounds and cells of each block.

    Blocks are cut at approximate quantiles of the norms; one that holds too many equal
    norms is split over several cells by hash.
    """
    normed = items.withColumn("_norm", _norm("vector"))
    cuts = normed.agg(F.percentile_approx("_norm", [1 - (b + 1) / blocks for b in range(blocks - 1)], 10_000)).first()[0]
    block = sum((F.when(F.col("_norm") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    normed = normed.withColumn("_block", block)
    found = {r["_block"]: r for r in normed.groupBy("_block").agg(F.max("_norm").alias("top"), F.count("*").alias("n")).collect()}
    cells = [math.ceil(found[b]["n"] / cell_rows) if b in found else 0 for b in range(blocks)]
    first = F.array(*[F.lit(sum(cells[:b])) for b in range(blocks)])
    inside = F.pmod(F.xxhash64("item_id"), F.get(F.array(*[F.lit(max(1, c)) for c in cells]), F.col("_block")))
    placed = normed.withColumn("_i", (F.get(first, F.col("_block")) + inside).cast("int")).drop("_norm")
    return placed, [found[b]["top"] if b in found else -1.0 for b in range(blocks)], cells


def reachable_blocks(least: str, norm: str, tops: list[float]) -> Column:
    """Blocks after the first that may hold an item scoring ``least`` for a user of that norm; all where it is null."""
    bounds = F.array(*[F.lit(float(t)) for t in tops])
    may = lambda b: F.col(least).isNull() | (F.get(bounds, b) * F.col(norm) * (1 + 1e-9) >= F.col(least))
    return F.filter(F.sequence(F.lit(1), F.lit(len(tops) - 1)), lambda b: (F.get(bounds, b) >= 0) & may(b))


def dot_top_n(
    user_vectors: DataFrame, item_vectors: DataFrame, n: int, cell_rows: int | None = None, bounds: str = "cones"
) -> DataFrame:
    """Each user's ``n`` items of greatest dot product, over all items.

    Items are cut into blocks, by direction and norm (``cones``, see
    :mod:`shelfwise.operators.cones`) or by norm alone (``norms``). Every user is scored
    against the most promising block first; the score of the ``n``-th bounds what another
    block must be able to give, and only blocks that can see the user. A cell scores a group
    of users against items with a matrix product and emits ``n`` items per user; the lists
    then compete in :func:`top_n`. No (user, item) pair is ever a row, and what a cell
    holds does not grow with the data. A vector that is null, holds nulls or has another
    width than the widest is an error that names its id.
    """
    if bounds not in ("cones", "norms"):
        raise ValueError(f"bounds are 'cones' or 'norms', not {bounds!r}")
    (user_rows, _), (item_rows, width) = _size(user_vectors), _size(item_vectors)
    cell_rows = cell_rows or max(1, CELL_ENTRIES // width)
    # A cell's lists count too: many short vectors with long lists would outgrow it.
    group_rows = min(cell_rows, max(1, LIST_ENTRIES // max(1, min(n, item_rows))))
    across, down = max(1, math.ceil(user_rows / group_rows)), max(1, math.ceil(item_rows / cell_rows))
    # Spare parallelism is taken from the user side, which does not add rows to the result.
    cores = user_vectors.sparkSession.sparkContext.defaultParallelism
    across = max(across, min(math.ceil(cores / down), max(1, user_rows // 256)))
    # Both sides may come from one table; the aliases keep their columns apart.
    users = user_vectors.select(F.col("user_id").cast("long").alias("user_id"), F.col("vector").alias("vector"))
    users = users.withColumn("_u", F.pmod(F.xxhash64("user_id"), F.lit(across)).cast("int"))
    items = item_vectors.select(F.col("item_id").cast("long").alias("item_id"), F.col("vector").alias("vector"))

    def scored(asking: DataFrame, offered: DataFrame) -> DataFrame:
        """Users with their cells ``_i`` against items, each copied to all groups of users."""
        spread = offered.withColumn("_u", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
        cells = asking.select("user_id", "vector", "_u", "_i").groupBy("_u", "_i")
        both = cells.cogroup(spread.select("item_id", "vector", "_u", "_i").groupBy("_u", "_i"))
        return both.applyInArrow(_cell_top(n, width), "user_id bigint, item_id bigint, score double")

    if down == 1:
        return top_n(scored(users.withColumn("_i", F.lit(0)), items.withColumn("_i", F.lit(0))), n)

    if bounds == "cones":
        return _cone_top_n(users.drop("_u"), items, n, width, cell_rows, min(group_rows, math.ceil(user_rows / across)))

    placed, tops, cells = _item_blocks(items, down, cell_rows)
    placed = write_down(placed, "item-blocks").table
    in_first = users.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(cells[0] - 1))))
    first = write_down(top_n(scored(in_first, placed.where("_block = 0")), n), "first-block").table
    least = first.where(F.col("rank") == n).select("user_id", F.col("score").alias("_least"))
    starts = F.array(*[F.lit(sum(cells[:b])) for b in range(down)])
    ends = F.array(*[F.lit(sum(cells[: b + 1]) - 1) for b in range(down)])
    asking = (
        users.withColumn("_norm", _norm("vector"))
        .join(least, "user_id", "left")
        .withColumn("_b", F.explode(reachable_blocks("_least", "_norm", tops)))
        .withColumn("_i", F.explode(F.sequence(F.get(starts, F.col("_b")), F.get(ends, F.col("_b")))))
    )
    more = scored(asking, placed.where("_block > 0"))
    return top_n(first.select("user_id", "item_id", "score").unionByName(more), n)


def _whole(vectors: DataFrame, key: str, width: int) -> DataFrame:
    """``vectors``, each checked when it is read: null, incomplete and odd ones are errors that name their id."""
    whole = (F.size("vector") == width) & ~F.exists("vector", lambda v: v.isNull() | F.isnan(v.cast("double")))
    text = F.concat(F.lit(f"{key} "), F.col(key).cast("string"), F.lit(f" has no vector of {width} entries, or one with missing entries"))
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("vector")).otherwise(F.raise_error(text).cast(vectors.schema["vector"].dataType))
    return vectors.withColumn("vector", checked)


def _cone_top_n(users: DataFrame, items: DataFrame, n: int, width: int, cell_rows: int, group_rows: int) -> DataFrame:
    """Users meet the cells of their most promising cones, then those that the ``n``-th score does not rule out."""
    placed, cones = cone_blocks(_whole(items, "item_id", width), cell_rows)
    placed = write_down(placed, "item-cells").table
    shown = write_down(asking(_whole(users, "user_id", width), cones, n), "first-cones").table
    shown = write_down(grouped(shown, cones, group_rows), "grouped-users").table

    def scored(asked: DataFrame) -> DataFrame:
        """An item is copied to the groups of users that ask its cell, and no others."""
        askers = write_down(in_cells(asked, cones), "askers").table
        cells = askers.select(F.col("_u").alias("_to"), F.col("_i").alias("_cell")).distinct()
        offered = placed.join(cells, F.col("_i") == F.col("_cell")).select("item_id", "vector", "_to", "_cell")
        both = askers.groupBy("_u", "_i").cogroup(offered.groupBy("_to", "_cell"))
        return both.applyInArrow(_cell_top(n, width), "user_id bigint, item_id bigint, score double")

    first = write_down(top_n(scored(shown), n), "first-lists").table
    least = first.where(F.col("rank") == n).select("user_id", F.col("score").alias("_least"))
    more = asking(users, cones, n, shown, least)
    groups = shown.select(F.col("user_id").alias("_user"), "_u")
    again = more.where(F.size("blocks") > 0).join(groups, F.col("user_id") == F.col("_user")).drop("_user")
    return top_n(first.select("user_id", "item_id", "score").unionByName(scored(again)), n)
