"""Sharded tables, submission files, metric files and keyed tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.expressions import shard_of
from shelfwise.functions.sqltext import ticked
from shelfwise.sources import commits
from shelfwise.sources.commits import path_exists as path_exists

SHARD = "_shard"
# Fixed value: header of the ranked-items column in a submission file.
SUBMISSION_ITEMS = "item_id_1 item_id_2 ... item_id_100"


def with_shard(df: DataFrame, key: str = "user_id", shards: int = 64) -> DataFrame:
    return df.withColumn(SHARD, shard_of(key, shards).cast("int"))


def shard_counts(df: DataFrame, key: str = "user_id", shards: int = 64) -> DataFrame:
    """Rows that each shard of a sharded write holds."""
    return df.groupBy(shard_of(key, shards).alias("shard")).agg(F.count("*").alias("n_rows"))


def _by_shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    return with_shard(df, key, shards).hint("rebalance", SHARD)


def write_sharded(df: DataFrame, path: str, key: str = "user_id", shards: int = 64) -> commits.Entry:
    """One directory per shard in a version of its own, which replaces the table as a whole.

    Rebalancing by shard gathers small shards into one file each and splits large ones
    over several tasks, so neither a hot user nor a small shard count makes one task
    write a whole shard. The manifest keeps the schema, so an empty table can be read.
    """
    return commits.replace(_by_shard(df, key, shards), path, [SHARD], key=key, shards=shards)


def write_sharded_part(df: DataFrame, path: str, key: str = "user_id", shards: int = 64) -> commits.Entry:
    """As :func:`write_sharded`, for a table of a set: older versions stay until the set is committed."""
    staged = commits.stage(_by_shard(df, key, shards), path, [SHARD], key=key, shards=shards)
    return commits.commit(df.sparkSession, path, staged)


def read_sharded(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of :func:`write_sharded` without its shard column; None where there is none."""
    found = commits.read(spark, path)
    return None if found is None else found.drop(SHARD)


def submission(recommendations: DataFrame, top_n: int = 100) -> DataFrame:
    """One row per user, the item ids of ranks 1..n joined by spaces."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "item_id")))
    return (
        recommendations.where(F.col("rank") <= top_n)
        .groupBy("user_id")
        .agg(F.array_join(F.transform(ranked, lambda r: r["item_id"].cast("string")), " ").alias(SUBMISSION_ITEMS))
    )


def write_submission(recommendations: DataFrame, path: str, top_n: int = 100) -> None:
    """The file that is handed in; an earlier one stays until this one is complete."""
    rows = submission(recommendations, top_n)
    commits.swap_in(rows.sparkSession, path, lambda folder: rows.write.csv(folder, header=True))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """``(metric, value)`` rows as one flat JSON object.

    The few metric rows come to the driver once, so what they summarise is computed once.
    """
    rows = sorted((r["metric"], r["value"]) for r in metrics.select("metric", "value").collect())
    schema = ", ".join(f"{ticked(name)} double" for name, _ in rows)
    wide = metrics.sparkSession.createDataFrame([tuple(value for _, value in rows)], schema)
    commits.swap_in(metrics.sparkSession, path, lambda folder: wide.coalesce(1).write.json(folder))


def table_key(settings: Mapping[str, Any]) -> str:
    """A folder name for typed settings: names in order, each with its type and value."""
    digest = hashlib.sha256()
    for name in sorted(settings):
        value = settings[name]
        digest.update(f"{name}:{type(value).__name__}={value!r}\n".encode())
    return digest.hexdigest()[:16]


def keyed_table(
    spark: SparkSession,
    root: str,
    name: str,
    params: Mapping[str, Any],
    build: Callable[[], DataFrame],
    inputs: Sequence[str] = (),
    patience: float = commits.PATIENCE_SECONDS,
) -> DataFrame:
    """Build a table once per parameter set and state of its input files, and reuse the written one afterwards.

    The operator name is part of the key; of ``inputs`` name, length and modification time
    of every file are. Several builders at once give one table, built by one of them.
    """
    key = {"table": name, **params}
    if inputs:
        key["_inputs"] = commits.fingerprint(spark, *inputs)
    return commits.build_once(spark, f"{root.rstrip('/')}/{table_key(key)}/{name}", build, patience)
