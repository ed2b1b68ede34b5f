"""Ids that a large part of all rows have: found in one pass, joined without gathering their rows.

The summary is Misra and Gries's: a bounded number of counters a task, from which the same
amount is taken whenever there are too many. Counters of several tasks add up; a sum is
below the true count by at most rows / (counters + 1).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.workspace import write_down


def _summary(counters: int):
    """Counters of one task. What is taken off is noted, as a row without an id."""

    def run(batches):
        ids, counts, taken, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy()
            rows += len(values)
            fresh, number = np.unique(values, return_counts=True)
            merged = np.concatenate([ids, fresh])
            ids, at = np.unique(merged, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, number])).astype(np.int64)
            if len(ids) > counters:
                off = int(np.partition(counts, -counters - 1)[-counters - 1])
                taken += off
                kept = counts > off
                ids, counts = ids[kept], counts[kept] - off
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *ids.tolist()], pa.int64()), pa.array([taken, *counts.tolist()], pa.int64()), pa.array([rows] + [0] * len(ids), pa.int64())],
                ["id", "n", "rows"],
            )

    return run


def summarise(rows: DataFrame, column: str, counters: int) -> DataFrame:
    """``id, at_least, at_most, total``: bounds of the counts of the ids that kept a counter in some task, from one pass.

    Bounds are apart by at most total / (counters + 1), which is also the most that an id
    without a counter can have. At most (tasks * counters) rows are added up.
    """
    parts = rows.select(F.col(column).cast("long").alias("id")).mapInArrow(_summary(counters), "id long, n long, rows long")
    summed = write_down(parts.groupBy("id").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")), "counters").table
    rest = summed.where("id IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("off"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total")).first()
    return summed.where("id IS NOT NULL").select(
        "id", F.col("n").alias("at_least"), (F.col("n") + F.lit(rest["off"])).alias("at_most"), F.lit(rest["total"]).cast("long").alias("total")
    )


def hot_ids(rows: DataFrame, column: str, share: float, exact: bool = False) -> DataFrame:
    """``id, n``: every id with more than ``share`` of the rows that have one; at most 2 / ``share`` ids.

    The summary leaves none out; it may add ids with more than half of that share, and ``n``
    is a lower bound. ``exact`` counts the candidates in a second pass and keeps the right ones.
    """
    found = summarise(rows, column, math.ceil(2 / share)).where(F.col("at_least") > F.col("total") * (share / 2))
    if not exact:
        return found.select("id", F.col("at_least").alias("n"))
    named = F.broadcast(found.select(F.col("id").alias(column), "total"))
    counted = rows.join(named, column).groupBy(F.col(column).alias("id")).agg(F.count("*").alias("n"), F.first("total").alias("total"))
    return counted.where(F.col("n") > F.col("total") * share).select("id", "n")


def join_apart(rows: DataFrame, table: DataFrame, keys: Sequence[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``table`` by ``keys``; those with ``hot`` keys meet copies of their few table rows where they are.

    ``hot`` has distinct keys, few enough to be sent to every task; ``table`` has one row per
    key; ``how`` is inner or left. The other rows are shuffled by key, and no key among them
    is hot. Null keys match nothing, and in a left join stay where they are too.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    keys = list(keys)
    known = F.broadcast(hot.select(*keys).distinct())
    near = table.join(known, keys, "left_semi")
    complete = [F.col(k).isNotNull() for k in keys]
    whole = complete[0]
    for c in complete[1:]:
        whole = whole & c
    few = rows.join(known, keys, "left_semi").join(F.broadcast(near), keys, how)
    many = rows.where(whole).join(known, keys, "left_anti").join(table.join(known, keys, "left_anti"), keys, how)
    out = few.unionByName(many)
    if how == "left":
        out = out.unionByName(rows.where(~whole), allowMissingColumns=True)
    return out
