"""Bayesian personalised ranking (Rendle et al. 2009) as a sequence of Spark jobs.

Positives are spread over blocks of bounded size. In an epoch every block asks for the
vectors its triples touch (one row per block and vector, however often a popular item
occurs in it), runs mini-batch steps on its copies, and returns one change per vector.
Changes are averaged by the number of steps behind them. The next epoch starts from the
written vectors, so a lost executor costs at most the current epoch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.models.factors import FactorModel
from shelfwise.operators.idmaps import index_interactions
from shelfwise.operators.ratings import popularity_by_weight
from shelfwise.operators.splits import BROADCAST_USERS
from shelfwise.sources import commits
from shelfwise.sources.sinks import table_key
from shelfwise.workspace import Written, discard, write_down

# Positives of a block, and vector entries it may touch (three vectors a positive at most).
BLOCK_POSITIVES = 200_000
BLOCK_ENTRIES = 64_000_000
MINI_BATCH = 256
USER, ITEM = 0, 1
VECTOR = "array<float>"


def _draw(n: int | Column, *parts: Column | int) -> Column:
    """A number in ``[0, n)`` that depends only on the parts, not on where the row is."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(n).cast("long"))


def bpr_triples(positives: DataFrame, n_items: int, draw: int = 0, seed: int = 42, verify: bool = True) -> DataFrame:
    """Adds ``neg_idx`` to ``(user_idx, item_idx)``: an item that is no positive of the user.

    One item is drawn per positive; a draw that hits a positive is dropped, unless
    ``verify`` is off. The same seed and draw give the same triples in any row order and on
    any retry.
    """
    drawn = positives.withColumn("neg_idx", _draw(n_items, F.col("user_idx"), F.col("item_idx"), draw, seed))
    if not verify:
        return drawn
    taken = positives.select("user_idx", F.col("item_idx").alias("neg_idx"))
    return drawn.join(taken, ["user_idx", "neg_idx"], "left_anti")


def drawn_vectors(ids: DataFrame, side: int, factors: int, seed: int = 42) -> DataFrame:
    """``side, idx, vector``: small start values drawn by md5 of side, index, place and seed.

    The last entry is 1 for users and the bias, 0 at first, for items.
    """
    unit = 1 << 20
    values = F.transform(
        F.sequence(F.lit(0), F.lit(factors - 1)),
        lambda d: (_draw(unit, F.lit(side), F.col("idx"), d, seed) / unit - 0.5) / factors,
    )
    last = F.array(F.lit(1.0 if side == USER else 0.0))
    return ids.select(F.lit(side).alias("side"), "idx", F.concat(values, last).cast(VECTOR).alias("vector"))


def _block_steps(rate: float, reg: float, seed: int):
    """Mini-batch steps on one block; returns the change of every vector it touched."""

    def positions(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return np.searchsorted(known, wanted)

    def run(triples: pa.Table, vectors: pa.Table) -> pa.Table:
        side = vectors.column("side").to_numpy()
        idx = vectors.column("idx").to_numpy()
        flat = vectors.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        table = flat.reshape(len(idx), -1)
        sides = {}
        for which in (USER, ITEM):
            rows = np.flatnonzero(side == which)
            rows = rows[np.argsort(idx[rows])]
            # A copy to work on; the start values stay in the arrived rows.
            sides[which] = (idx[rows], table[rows], rows)
        (user_ids, users, user_rows), (item_ids, items, item_rows) = sides[USER], sides[ITEM]
        steps = np.zeros(len(users)), np.zeros(len(items))

        ids = [triples.column(c).to_numpy() for c in ("user_idx", "item_idx", "neg_idx")]
        # Arrival order depends on the shuffle; the shuffle below must not.
        ids = [col[np.lexsort(ids[::-1])] for col in ids]
        mixed = np.random.default_rng(seed).permutation(len(ids[0]))
        u, i, j = (positions(known, col[mixed]) for known, col in zip((user_ids, item_ids, item_ids), ids))
        for at in range(0, len(u), MINI_BATCH):
            bu, bi, bj = u[at : at + MINI_BATCH], i[at : at + MINI_BATCH], j[at : at + MINI_BATCH]
            vu, vi, vj = users[bu], items[bi], items[bj]
            pull = 1.0 / (1.0 + np.exp(np.einsum("nd,nd->n", vu, vi - vj)))
            pull = pull[:, None]
            to_user = rate * (pull * (vi - vj) - reg * vu)
            to_user[:, -1] = 0.0
            np.add.at(users, bu, to_user)
            np.add.at(items, bi, rate * (pull * vu - reg * vi))
            np.add.at(items, bj, rate * (-pull * vu - reg * vj))
            np.add.at(steps[0], bu, 1.0)
            np.add.at(steps[1], bi, 1.0)
            np.add.at(steps[1], bj, 1.0)

        users -= table[user_rows]
        items -= table[item_rows]
        change = np.concatenate([users, items])
        weight = np.concatenate(steps)
        change *= weight[:, None].astype(np.float32)
        width = table.shape[1]
        return pa.table(
            {
                "side": pa.array(np.repeat([USER, ITEM], [len(users), len(items)]), pa.int32()),
                "idx": pa.array(np.concatenate([user_ids, item_ids]), pa.int64()),
                "change": pa.ListArray.from_arrays(
                    pa.array(np.arange(len(change) + 1) * width, pa.int32()), pa.array(change.ravel(), pa.float32())
                ),
                "steps": pa.array(weight),
            }
        )

    return run


def _with_blocks(positives: DataFrame, rows: int, block_rows: int) -> DataFrame:
    """Block of each positive: by user, and by user and item for users that fill several.

    The number of blocks follows from the rows alone, so the model does not depend on the
    cluster.
    """
    blocks = max(1, math.ceil(rows / block_rows))
    heavy = (
        positives.groupBy("user_idx")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > block_rows)
        .select("user_idx", F.ceil(F.col("_n") / block_rows).alias("_parts"))
    )
    # At most (all positives / block_rows) users are heavy.
    if rows / block_rows <= BROADCAST_USERS:
        heavy = F.broadcast(heavy)
    spread = positives.join(heavy, "user_idx", "left")
    part = F.pmod(F.xxhash64("item_idx"), F.coalesce("_parts", F.lit(1)))
    block = F.pmod(F.xxhash64("user_idx", part), F.lit(blocks)).cast("int")
    return spread.select("user_idx", "item_idx", block.alias("block"))


def _epoch(
    vectors: DataFrame, positives: DataFrame, n_items: int, epoch: int, rate: float, reg: float, seed: int, verify: bool = True
) -> DataFrame:
    triples = bpr_triples(positives, n_items, epoch, seed, verify)
    touched = triples.select(
        "block",
        F.inline(
            F.array(
                F.struct(F.lit(USER).alias("side"), F.col("user_idx").alias("idx")),
                F.struct(F.lit(ITEM).alias("side"), F.col("item_idx").alias("idx")),
                F.struct(F.lit(ITEM).alias("side"), F.col("neg_idx").alias("idx")),
            )
        ),
    ).distinct()
    lent = touched.withColumnRenamed("block", "lent_to").join(vectors, ["side", "idx"])
    changes = (
        triples.groupBy("block")
        .cogroup(lent.groupBy("lent_to"))
        .applyInArrow(
            _block_steps(rate, reg, seed + epoch), "side int, idx bigint, change array<float>, steps double"
        )
    )
    # Changes come weighted by their steps; vectors are summed as vectors, however wide.
    total = Summarizer.sum(array_to_vector(F.col("change").cast("array<double>")))
    moved = changes.groupBy("side", "idx").agg(F.sum("steps").alias("_steps"), vector_to_array(total).alias("_sum"))
    mean = F.when(F.col("_steps") > 0, F.transform("_sum", lambda v: v / F.col("_steps")))
    moved = moved.select("side", "idx", mean.alias("_move"))
    updated = vectors.join(moved, ["side", "idx"], "left")
    return updated.select(
        "side",
        "idx",
        F.when(F.col("_move").isNull(), F.col("vector"))
        .otherwise(F.zip_with("vector", "_move", lambda v, m: v + F.coalesce(m, F.lit(0.0))))
        .cast(VECTOR)
        .alias("vector"),
    )


def _beside(model_vectors: DataFrame, triples: DataFrame) -> DataFrame:
    """Triples with the vectors of their user and items, ``_u``, ``_i``, ``_j``, and the difference of their scores, ``_gap``."""

    def side(which: int, key: str, name: str) -> DataFrame:
        doubles = F.col("vector").cast("array<double>").alias(name)
        return model_vectors.where(F.col("side") == which).select(F.col("idx").alias(key), doubles)

    joined = (
        triples.join(side(USER, "user_idx", "_u"), "user_idx")
        .join(side(ITEM, "item_idx", "_i"), "item_idx")
        .join(side(ITEM, "neg_idx", "_j"), "neg_idx")
    )
    products = F.zip_with("_u", F.zip_with("_i", "_j", lambda a, b: a - b), lambda u, d: u * d)
    return joined.withColumn("_gap", F.aggregate(products, F.lit(0.0), lambda total, v: total + v))


def pairwise_loss(model_vectors: DataFrame, triples: DataFrame) -> DataFrame:
    """Mean of -ln(sigmoid(score difference)) over triples, for watching convergence."""
    return _beside(model_vectors, triples).agg(F.avg(F.log1p(F.exp(-F.col("_gap")))).alias("loss"))


def gradient_step(model_vectors: DataFrame, triples: DataFrame, rate: float, reg: float) -> DataFrame:
    """``side, idx, vector, n``: all vectors after one step along the whole gradient, and their occurrences in triples.

    A vector moves by ``rate`` times the mean, over its occurrences, of the loss's
    gradient minus ``reg`` times itself; the 1 of a user stays. Vectors are joined to the
    triples and their changes summed on the map side first, so a popular item is no hot spot
    of the aggregation. The blocks of :func:`train_vectors` approach the same
    direction in mini-batches.
    """
    pull = 1 / (1 + F.exp(F.col("_gap")))
    rows = _beside(model_vectors, triples).withColumn("_pull", pull)

    def moved(which: int, key: str, change: Column):
        return F.struct(F.lit(which).alias("side"), F.col(key).alias("idx"), change.alias("change"))

    to_user = F.transform(F.zip_with("_i", "_j", lambda a, b: a - b), lambda d: d * F.col("_pull"))
    to_item = F.transform("_u", lambda u: u * F.col("_pull"))
    from_item = F.transform("_u", lambda u: -u * F.col("_pull"))
    changes = rows.select(
        F.inline(F.array(moved(USER, "user_idx", to_user), moved(ITEM, "item_idx", to_item), moved(ITEM, "neg_idx", from_item)))
    )
    total = vector_to_array(Summarizer.sum(array_to_vector("change")))
    summed = changes.groupBy("side", "idx").agg(F.count("*").alias("n"), total.alias("_sum"))
    joined = model_vectors.join(summed, ["side", "idx"], "left")
    stepped = F.zip_with(
        F.col("vector").cast("array<double>"), "_sum", lambda v, g: v + F.lit(float(rate)) * (g / F.col("n") - F.lit(float(reg)) * v)
    )
    whole = F.when(F.col("n").isNull(), F.col("vector").cast("array<double>")).otherwise(stepped)
    # The last entry of a user is no parameter.
    kept = F.transform(whole, lambda v, d: F.when((F.col("side") == USER) & (d == F.size("vector") - 1), F.lit(1.0)).otherwise(v))
    return joined.select("side", "idx", kept.alias("vector"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def _run_key(positives: DataFrame, user_map: DataFrame, item_map: DataFrame, **settings) -> str:
    """Folder name of a training run: its settings and the rows it learns from, in any order."""
    rows = positives.agg(F.count("*"), F.bit_xor(F.xxhash64("user_idx", "item_idx")), F.sum(F.xxhash64("item_idx", "user_idx").cast("decimal(20,0)"))).first()
    maps = [m.agg(F.count("*"), F.bit_xor(F.xxhash64("ext_id", "idx"))).first() for m in (user_map, item_map)]
    return table_key({**settings, "rows": str(rows), "maps": str(maps)})


def train_vectors(
    positives: DataFrame,
    user_map: DataFrame,
    item_map: DataFrame,
    factors: int,
    learning_rate: float,
    regularization: float,
    iterations: int,
    seed: int = 42,
    block_rows: int = BLOCK_POSITIVES,
    verify_negatives: bool = True,
    ledger: str | None = None,
) -> Written:
    """``(side, idx, vector)`` after the given number of epochs; vectors are ``factors + 1`` wide.

    With a ``ledger`` folder every epoch is committed there, under the settings and rows of
    the run, and a job that is started again goes on behind the last epoch. More iterations
    of the same run go on too. Without one, epochs live in the session's scratch folder.
    """
    n_items = item_map.count()
    block_rows = min(block_rows, max(1, BLOCK_ENTRIES // (3 * (factors + 1))))
    spark = positives.sparkSession
    first, path = 0, None
    if ledger:
        settings = {"factors": factors, "rate": learning_rate, "reg": regularization, "seed": seed, "block": block_rows, "verify": verify_negatives}
        path = f"{ledger.rstrip('/')}/{_run_key(positives, user_map, item_map, **settings)}"
        done = [e for e in commits.entries(spark, path) if e.facts["epochs"] <= iterations]
        if done:
            first, version = done[-1].facts["epochs"], done[-1].version
            vectors = Written(commits.read(spark, path, version), commits.folder_of(path, version))
    placed = write_down(_with_blocks(positives, positives.count(), block_rows), "bpr-positives")

    def note(table: DataFrame, epochs: int) -> Written:
        if path is None:
            return write_down(table, "bpr-vectors")
        entry = commits.commit(spark, path, commits.stage(table, path, epochs=epochs))
        return Written(commits.read(spark, path, entry.version), commits.folder_of(path, entry.version))

    if first == 0 and not (ledger and done):
        start = drawn_vectors(user_map, USER, factors, seed).unionByName(drawn_vectors(item_map, ITEM, factors, seed))
        vectors = note(start, 0)
    for epoch in range(first, iterations):
        step = _epoch(vectors.table, placed.table, n_items, epoch, learning_rate, regularization, seed, verify_negatives)
        stepped = note(step, epoch + 1)
        if path is None:
            discard(spark, vectors.path)
        else:
            commits.sweep(spark, path)
        vectors = stepped
    discard(spark, placed.path)
    return vectors


def fit_bpr(
    ratings: DataFrame,
    user_map: DataFrame,
    item_map: DataFrame,
    factors: int = 128,
    learning_rate: float = 0.01,
    regularization: float = 0.01,
    iterations: int = 30,
    seed: int = 42,
    verify_negatives: bool = True,
    ledger: str | None = None,
) -> FactorModel:
    """Rank every user's positively rated items above the others; weights are ignored.

    ``ratings`` has one row per (user, item). Users without a positive get no vector. With a
    ``ledger`` folder an interrupted fit goes on behind its last epoch.
    """
    positives = index_interactions(ratings.where(F.col("rating") > 0), user_map, item_map)
    positives = write_down(positives.select("user_idx", "item_idx"), "bpr-pairs")
    vectors = train_vectors(
        positives.table, user_map, item_map, factors, learning_rate, regularization, iterations, seed,
        verify_negatives=verify_negatives, ledger=ledger,
    )

    def external(side: int, ids: DataFrame, name: str) -> DataFrame:
        mine = vectors.table.where(F.col("side") == side)
        named = ids.join(mine, "idx").select(F.col("ext_id").alias(name), "vector")
        return write_down(named, f"bpr-{name}").table

    trained = positives.table.select(F.col("user_idx").alias("idx"))
    model = FactorModel(
        "bpr",
        external(USER, user_map.join(trained, "idx", "left_semi"), "user_id"),
        external(ITEM, item_map, "item_id"),
        popularity_by_weight(ratings),
    )
    for table in (positives,) if ledger else (positives, vectors):
        discard(ratings.sparkSession, table.path)
    return model
