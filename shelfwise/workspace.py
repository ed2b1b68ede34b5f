"""Shared scratch space: where a plan is cut and its rows are written down.

A written table survives lost executors, keeps columns prunable and ends the
lineage. It lives under the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Written(NamedTuple):
    """A written table and the folder that holds it."""

    table: DataFrame
    path: str


# The folder of each session that has written something, by application id.
_RUNS: dict[str, tuple[SparkSession, str]] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a private one only for an unconfigured local run.

    On a cluster the folder must be one that every executor reaches, so a missing setting
    and a local path are errors.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    single = context.master.startswith("local")  # local-cluster too: one machine
    if configured:
        if not single and configured.startswith("file:"):
            raise RuntimeError("spark.checkpoint.dir is a local folder; executors on other machines cannot reach it")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not single:
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))
    return context.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """A folder of this session's own, which goes when the program ends."""
    name = spark.sparkContext.applicationId
    if name not in _RUNS:
        _RUNS[name] = (spark, f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}")
    return _RUNS[name][1]


@atexit.register
def _clear() -> None:
    """Delete what the sessions that still run have written down."""
    for spark, path in _RUNS.values():
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            discard(spark, path)
    _RUNS.clear()


def write_down(df: DataFrame, name: str) -> Written:
    """Write ``df`` as Parquet in the checkpoint folder."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return Written(spark.read.schema(df.schema).parquet(path), path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
