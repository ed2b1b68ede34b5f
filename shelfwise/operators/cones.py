"""Bounds on dot products by direction and length: which blocks of items may hold a user's best.

Items are gathered around some directions. A cone is a direction and the angle of the
farthest item from it; for a user at angle f from the direction and a cone of angle t, no
item scores above |user| |longest item| cos(max(0, f - t)). Inside a cone items are cut by
length, so vectors of one length are told apart by direction and others by length too.
All that is kept of the items is a few numbers per block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.workspace import write_down

# Items the directions are fitted to, directions, levels of length in a cone, and rounds of fitting, at most.
SAMPLE_ITEMS = 20_000
DIRECTIONS = 1024
LEVELS = 4
ROUNDS = 12
# Numbers by row and block that a worker holds at a time.
BOUND_ENTRIES = 1_000_000


@dataclass(frozen=True)
class Cones:
    """Per block: its direction, the cosine of its angle, greatest and least length, items, and the cells they fill."""

    direction: np.ndarray
    cosine: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray
    rows: np.ndarray
    cells: np.ndarray

    @property
    def first_cell(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.cells)])

    def bounds(self, users: np.ndarray) -> np.ndarray:
        """The most that an item of each block can score for each user, a little above by rounding."""
        length = np.linalg.norm(users, axis=1)
        unit = users / np.where(length > 0, length, 1)[:, None]
        own = np.clip(unit @ self.direction.T, -1, 1)
        # cos(f - t) = cos f cos t + sin f sin t, and 1 inside the cone
        spread = own * self.cosine + np.sqrt(np.maximum(1 - own * own, 0)) * np.sqrt(np.maximum(1 - self.cosine**2, 0))
        spread = np.where(own >= self.cosine, 1.0, spread)
        bound = spread * np.where(spread >= 0, self.longest, self.shortest)
        return (bound + 1e-9 * self.longest) * length[:, None]


def _directions(items: DataFrame, wanted: int) -> np.ndarray:
    """Directions that the sampled items lie around, by k-means on the sphere."""
    sample = items.orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE_ITEMS).select("vector").toArrow()
    rows = np.array(sample["vector"].to_pylist(), float)
    length = np.linalg.norm(rows, axis=1)
    rows = rows[length > 0] / length[length > 0][:, None]
    if not len(rows):
        return np.zeros((0, rows.shape[1] if rows.ndim == 2 else 1))
    random = np.random.default_rng(7)
    centres = rows[random.choice(len(rows), min(wanted, len(rows)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        size = np.linalg.norm(sums, axis=1)
        # a direction without items keeps its place
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], centres)
    return centres


def _pieces(batches, blocks: int):
    """The batches in pieces whose rows times ``blocks`` are bounded, without empty ones."""
    rows = max(1, BOUND_ENTRIES // max(1, blocks))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _assign(centres: np.ndarray):
    def run(batches):
        for batch in _pieces(batches, len(centres)):
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            length = np.linalg.norm(rows, axis=1)
            found = rows / np.where(length > 0, length, 1)[:, None] @ centres.T
            # items of length 0 score 0 for everyone, and get a block of their own
            cone = np.where(length > 0, found.argmax(axis=1), len(centres)).astype(np.int32)
            cosine = np.where(length > 0, np.take_along_axis(found, np.minimum(cone, len(centres) - 1)[:, None], 1)[:, 0], 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cone), pa.array(cosine), pa.array(length)], ["item_id", "vector", "cone", "cosine", "length"]
            )

    return run


def cone_blocks(items: DataFrame, cell_rows: int) -> tuple[DataFrame, Cones]:
    """``item_id, vector, block, _i`` (the cell), written down, and the bounds of all blocks.

    ``items`` has whole vectors. Directions are fitted on at most ``SAMPLE_ITEMS`` items, all
    items are assigned; a block that fills several cells is dealt over them by hash.
    """
    total = items.count()
    centres = _directions(items, min(DIRECTIONS, max(1, math.ceil(total / cell_rows))))
    if not len(centres):
        centres = np.zeros((1, len(items.first()["vector"])))
        centres[0, 0] = 1.0
    kind = items.schema["vector"].dataType.simpleString()
    placed = write_down(
        items.select("item_id", "vector").mapInArrow(_assign(centres), f"item_id bigint, vector {kind}, cone int, cosine double, length double"), "cones"
    ).table
    shares = [1 - (k + 1) / LEVELS for k in range(LEVELS - 1)]
    # At most DIRECTIONS + 1 rows.
    cones = placed.groupBy("cone").agg(F.count("*").alias("n"), F.percentile_approx("length", shares, 1000).alias("cuts"))
    cuts = cones.select("cone", F.when(F.col("n") > cell_rows, F.col("cuts")).otherwise(F.array().cast("array<double>")).alias("cuts"))
    level = F.size(F.filter("cuts", lambda c: F.col("length") <= c))
    leveled = placed.join(F.broadcast(cuts), "cone").select("item_id", "vector", "cosine", "length", (F.col("cone") * LEVELS + level).alias("block"))
    leveled = write_down(leveled, "leveled").table
    found = leveled.groupBy("block").agg(
        F.count("*").alias("n"), F.min("cosine").alias("cosine"), F.max("length").alias("longest"), F.min("length").alias("shortest")
    ).collect()
    blocks = (len(centres) + 1) * LEVELS
    numbers = {c: np.zeros(blocks) for c in ("n", "cosine", "longest", "shortest")}
    for row in found:
        for c, values in numbers.items():
            values[row["block"]] = row[c]
    cells = np.ceil(numbers["n"] / cell_rows).astype(np.int64)
    ends = np.vstack([np.repeat(centres, LEVELS, axis=0), np.zeros((LEVELS, centres.shape[1]))])
    bounds = Cones(ends, np.clip(numbers["cosine"] - 1e-9, -1, 1), numbers["longest"], numbers["shortest"], numbers["n"].astype(np.int64), cells)
    table = items.sparkSession.createDataFrame(
        [(b, int(bounds.first_cell[b]), int(cells[b])) for b in range(blocks) if cells[b]], "block int, first int, n_cells int"
    )
    inside = F.pmod(F.xxhash64("item_id"), F.col("n_cells"))
    celled = leveled.join(F.broadcast(table), "block").select("item_id", "vector", "block", (F.col("first") + inside).cast("int").alias("_i"))
    return celled, bounds


def _vectors(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _first(shared, n: int):
    """The block of greatest bound, and those from the greatest bound down that hold ``n`` items."""

    def run(batches):
        cones = shared.value
        for batch in _pieces(batches, len(cones.rows)):
            bounds = np.where(cones.rows > 0, cones.bounds(_vectors(batch.column(1))), -np.inf)
            order = np.argsort(-bounds, axis=1, kind="stable")
            enough = (np.cumsum(cones.rows[order], axis=1) < n).sum(axis=1) + 1
            lists = [order[r, : enough[r]][cones.rows[order[r, : enough[r]]] > 0].astype(np.int32) for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(order[:, 0].astype(np.int32)), pa.array(lists, pa.list_(pa.int32()))],
                ["user_id", "vector", "best", "blocks"],
            )

    return run


def _reachable(shared):
    """Blocks beyond the first ones that may hold an item as good as the least of the list so far."""

    def run(batches):
        cones = shared.value
        for batch in _pieces(batches, len(cones.rows)):
            bounds = np.where(cones.rows > 0, cones.bounds(_vectors(batch.column(1))), -np.inf)
            seen = batch.column(3).to_pylist()
            least = batch.column(4).to_numpy(zero_copy_only=False)
            lists = [np.setdiff1d(np.flatnonzero(bounds[r] >= (-np.inf if np.isnan(least[r]) else least[r])), seen[r]) for r in range(batch.num_rows)]
            lists = [x[cones.rows[x] > 0].astype(np.int32) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(lists, pa.list_(pa.int32()))], ["user_id", "vector", "best", "blocks"]
            )

    return run


def asking(users: DataFrame, cones: Cones, n: int, shown: DataFrame | None = None, least: DataFrame | None = None) -> DataFrame:
    """``user_id, vector, best, blocks``: the blocks a user is scored against first, or, given what it was
    shown and ``least(user_id, _least)``, the others that its ``n``-th score does not rule out."""
    shared = users.sparkSession.sparkContext.broadcast(cones)
    kind = users.schema["vector"].dataType.simpleString()
    schema = f"user_id bigint, vector {kind}, best int, blocks array<int>"
    if shown is None:
        return users.select("user_id", "vector").mapInArrow(_first(shared, n), schema)
    rows = shown.join(least, "user_id", "left").select("user_id", "vector", "best", "blocks", "_least")
    return rows.mapInArrow(_reachable(shared), schema)


def grouped(asked: DataFrame, cones: Cones, group_rows: int) -> DataFrame:
    """``asked`` with ``_u``: groups of at most about ``group_rows`` users of the same best block, who mostly ask the same cells."""
    counts = {r["best"]: r["n"] for r in asked.groupBy("best").agg(F.count("*").alias("n")).collect()}
    parts = np.zeros(len(cones.rows), np.int64)
    for block, n in counts.items():
        parts[block] = math.ceil(n / group_rows)
    starts = np.concatenate([[0], np.cumsum(parts)])
    rows = [(b, int(starts[b]), int(parts[b])) for b in counts]
    table = asked.sparkSession.createDataFrame(rows, "best int, _start int, _parts int")
    spread = (F.col("_start") + F.pmod(F.xxhash64("user_id"), F.col("_parts"))).cast("int").alias("_u")
    return asked.join(F.broadcast(table), "best").select("user_id", "vector", "best", "blocks", spread)


def in_cells(asked: DataFrame, cones: Cones) -> DataFrame:
    """One row for every user and cell it asks."""
    first = cones.first_cell
    rows = [(b, int(first[b]), int(cones.cells[b])) for b in range(len(cones.rows)) if cones.cells[b]]
    table = asked.sparkSession.createDataFrame(rows, "block int, first int, n_cells int")
    each = asked.withColumn("block", F.explode("blocks")).join(F.broadcast(table), "block")
    return each.withColumn("_i", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n_cells") - 1))).select("user_id", "vector", "_u", "_i")
