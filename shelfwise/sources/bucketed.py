"""Tables that are dealt by their keys once, when written, so that joins on these keys shuffle nothing.

A bucket holds all rows of the keys that hash to it, in one file. Spark skips the shuffle
below a join or an aggregation by the same keys, in as many buckets on both sides. Versions
and commits are those of :mod:`shelfwise.sources.commits`; the manifest keeps the keys and
the number of buckets, from which a session makes its catalog entry.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfwise.functions.sqltext import quoted, ticked
from shelfwise.sources import commits


def _name(version: str) -> str:
    return "bucketed_" + "".join(c if c.isalnum() else "_" for c in version)


def stage_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> commits.Entry:
    """A version in ``buckets`` files by the hash of ``keys``, not committed yet.

    The rows are dealt as Spark's own exchange deals them, so every task writes the one bucket it holds.
    """
    entry = commits.Entry(0, commits.new_version(), None, df.schema.json(), {"keys": list(keys), "buckets": buckets})
    folder, name = commits.folder_of(path, entry.version), _name(entry.version)
    dealt = df.repartition(buckets, *keys).write.format("parquet")
    dealt.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(name)
    return entry._replace(rows=df.sparkSession.table(name).count())


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> commits.Entry:
    """Replace the bucketed table at ``path`` as a whole."""
    done = commits.commit(df.sparkSession, path, stage_bucketed(df, path, keys, buckets))
    commits.sweep(df.sparkSession, path)
    return done


def read_bucketed(spark: SparkSession, path: str, version: str | None = None) -> DataFrame | None:
    """The newest version, or the one given, known to the planner as bucketed; None where there is none."""
    entry = commits.newest(spark, path) if version is None else commits.entry_of(spark, path, version)
    if entry is None:
        return None
    name = _name(entry.version)
    if not spark.catalog.tableExists(name):
        fields = StructType.fromJson(json.loads(entry.schema)).fields
        columns = ", ".join(f"{ticked(f.name)} {f.dataType.simpleString()}" for f in fields)
        keys = ", ".join(map(ticked, entry.facts["keys"]))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {int(entry.facts['buckets'])} BUCKETS LOCATION {quoted(commits.folder_of(path, entry.version))}"
        )
    return spark.table(name)
