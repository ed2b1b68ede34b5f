"""The normal equations of implicit-feedback factorisation: solving a half step, and checking one.

With item vectors y, confidences 1 + alpha |r|, and a preference of 1 for positive
ratings (0 otherwise), the vector x of a user with n positive ratings solves
(sum over all items of y y' + sum over rated ones of alpha |r| y y' + reg n I) x
= sum over the positive ones of (1 + alpha r) y.
The first sum, the Gram matrix, is the same for all users and as large as the model is
wide; everything else comes from a user's own ratings.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.workspace import write_down

# Ratings of a block, about; a user with more than that is summed in pieces.
BLOCK_RATINGS = 200_000


def gram(vectors: DataFrame) -> np.ndarray:
    """Sum of the outer products of all vectors: one partial sum a task, width * width numbers in all."""

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["g"])

    sums = vectors.select("vector").mapInArrow(partial, "g array<double>")
    whole = sums.agg(vector_to_array(Summarizer.sum(array_to_vector("g"))).alias("g")).first()["g"]
    width = math.isqrt(len(whole))
    return np.array(whole).reshape(width, width)


def _dot(a: str, b: str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)


def _sum_of(vector: Column) -> Column:
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def normal_equation_residuals(
    ratings: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, regularization: float, alpha: float = 1.0
) -> DataFrame:
    """``user_id, n_positive, residual, loss``: how far each rated user's vector is from solving its equations.

    ``residual`` is the length of (left side - right side) over that of the right side, 0
    for the exact solution; ``loss`` is the user's part of the objective over all items,
    with its penalty. Sums over a user's ratings combine on the map side, so a user with
    any number of them is no hot spot. Users without a vector or a positive rating do not
    appear.
    """
    whole = gram(item_vectors)
    width = len(whole)
    users = user_vectors.select("user_id", F.col("vector").cast("array<double>").alias("x"))
    items = item_vectors.select("item_id", F.col("vector").cast("array<double>").alias("y"))
    rows = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("r")).join(items, "item_id").join(users, "user_id")
    confidence = F.lit(float(alpha)) * F.abs("r")
    liked = (F.col("r") > 0).cast("double")
    rows = rows.withColumns({"s": _dot("x", "y"), "c": confidence, "p": liked})
    off, want = F.col("c") * F.col("s") - F.col("p") * (1 + F.col("c")), F.col("p") * (1 + F.col("c"))
    weighed = rows.select(
        "user_id",
        "p",
        F.transform("y", lambda v: v * off).alias("off"),
        F.transform("y", lambda v: v * want).alias("want"),
        ((1 + F.col("c")) * (F.col("p") - F.col("s")) ** 2 - F.col("s") ** 2).alias("part"),
    )
    summed = weighed.groupBy("user_id").agg(
        F.sum("p").alias("n"), _sum_of(F.col("off")).alias("off"), _sum_of(F.col("want")).alias("want"), F.sum("part").alias("part")
    )
    reg = float(regularization)

    def judge(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, off_, want_ = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for i in (1, 2, 3))
            n, part = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            left = x @ whole
            gap = left + off_ + reg * n[:, None] * x
            length = np.linalg.norm(want_, axis=1)
            loss = np.einsum("ij,ij->i", left, x) + part + reg * n * np.einsum("ij,ij->i", x, x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(np.linalg.norm(gap, axis=1) / length), pa.array(loss)],
                ["user_id", "n_positive", "residual", "loss"],
            )

    joined = summed.where("n > 0").join(users, "user_id").select("user_id", "x", "off", "want", "n", "part")
    kind = joined.schema["user_id"].dataType.simpleString()
    return joined.mapInArrow(judge, f"user_id {kind}, n_positive bigint, residual double, loss double")


def _solver(whole: np.ndarray, reg: float, alpha: float, most: int):
    """Vectors of the users of a block; of users in pieces the sums of each piece."""
    width = len(whole)

    def run(ratings: pa.Table, items: pa.Table) -> pa.Table:
        ids = items.column("lent_item").to_numpy()
        table = items.column("y").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.argsort(ids)
        ids, table = ids[order], table[order]
        user = ratings.column("user_id").to_numpy()
        pieces = ratings.column("pieces").to_numpy()
        # one order of rows whatever the shuffle's
        by_user = np.lexsort((ratings.column("item_id").to_numpy(), user))
        user, pieces = user[by_user], pieces[by_user]
        at = np.searchsorted(ids, ratings.column("item_id").to_numpy()[by_user])
        rating = ratings.column("r").to_numpy()[by_user]
        cuts = np.flatnonzero(np.concatenate([[True], user[1:] != user[:-1], [True]]))
        out = {"user_id": [], "vector": [], "sums": [], "n": []}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own, r = table[at[a:b]], rating[a:b]
            confidence, liked = alpha * np.abs(r), (r > 0).astype(float)
            left = (own * confidence[:, None]).T @ own
            right = ((1 + confidence) * liked) @ own
            out["user_id"].append(int(user[a]))
            out["n"].append(float(liked.sum()))
            if pieces[a] > 1:
                out["vector"].append(None)
                out["sums"].append(np.concatenate([left.ravel(), right]))
            else:
                out["vector"].append(np.linalg.solve(whole + left + reg * liked.sum() * np.eye(width), right) if liked.any() else None)
                out["sums"].append(None)
        numbers = pa.list_(pa.float64())
        return pa.table({
            "user_id": pa.array(out["user_id"], pa.int64()), "vector": pa.array(out["vector"], numbers),
            "sums": pa.array(out["sums"], numbers), "n": pa.array(out["n"], pa.float64()),
        })

    return run


def solve_users(
    ratings: DataFrame, item_vectors: DataFrame, regularization: float, alpha: float = 1.0, block_ratings: int = BLOCK_RATINGS
) -> DataFrame:
    """``user_id, vector``: the exact half step for given item vectors, for every user with a positive rating.

    It gives users who came after the training their vectors without fitting again. Ratings
    are dealt to blocks by user; a block gets each item vector it needs once. Users with
    more than ``block_ratings`` ratings are dealt in pieces, whose sums are added up.
    Ratings of items without a vector play no part.
    """
    whole = gram(item_vectors)
    width = len(whole)
    items = item_vectors.select(F.col("item_id").cast("long").alias("item_id"), F.col("vector").cast("array<double>").alias("y"))
    rows = ratings.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"), F.col("rating").cast("double").alias("r"))
    rows = rows.where("r <> 0").join(items.select("item_id"), "item_id", "left_semi")
    heavy = rows.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") > block_ratings)
    heavy = write_down(heavy.select("user_id", F.ceil(F.col("_n") / block_ratings).cast("long").alias("pieces")), "heavy-users").table
    # At most (all ratings / block_ratings) users.
    placed = rows.join(heavy, "user_id", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1).cast("long")))
    blocks = max(1, math.ceil(rows.count() / block_ratings))
    piece = F.pmod(F.xxhash64("item_id"), F.col("pieces"))
    placed = write_down(placed.withColumn("block", F.pmod(F.xxhash64("user_id", piece), F.lit(blocks)).cast("int")), "placed-ratings").table
    lent = placed.select(F.col("block").alias("lent_to"), F.col("item_id").alias("lent_item")).distinct()
    lent = lent.join(items, F.col("lent_item") == items["item_id"]).select("lent_to", "lent_item", "y")
    reg = float(regularization)
    solved = write_down(
        placed.groupBy("block").cogroup(lent.groupBy("lent_to")).applyInArrow(
            _solver(whole, reg, float(alpha), block_ratings), "user_id bigint, vector array<double>, sums array<double>, n double"
        ),
        "half-step",
    ).table

    def finish(batches):
        for batch in batches:
            sums, n = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            vectors = []
            for row, liked in zip(sums, n):
                left = np.array(row[: width * width]).reshape(width, width)
                right = np.array(row[width * width :])
                vectors.append(np.linalg.solve(whole + left + reg * liked * np.eye(width), right) if liked else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float64()))], ["user_id", "vector"])

    summed = solved.where("sums IS NOT NULL").groupBy("user_id").agg(_sum_of(F.col("sums")).alias("sums"), F.sum("n").alias("n"))
    large = summed.mapInArrow(finish, "user_id bigint, vector array<double>")
    return solved.select("user_id", "vector").unionByName(large).where("vector IS NOT NULL")
