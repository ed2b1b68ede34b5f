"""Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the click, order and item logs.
TRACKER_COLUMNS = ("user_id", "item_id", "timestamp", "action_type", "action_widget")
ORDER_COLUMNS = ("user_id", "item_id", "created_timestamp", "last_status", "last_status_timestamp")
ITEM_COLUMNS = ("item_id", "catalogid", "variant_id", "model_id", "itemname", "fclip_embed", "attributes")


def scan_selected(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    schema: str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Only the named columns of a Parquet directory; anything else in the files is ignored.

    Give ``schema`` (DDL) when files disagree on the columns that are not wanted, so
    that no file's footer decides for the others.
    """
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths).select(*columns)


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).parquet(path)


def rows_per_file(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Shard listing: the files below ``path`` that match ``glob``, by their path from there, and the rows of each."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/") + "/"
    name = F.col("_metadata.file_path")
    below = F.substring_index(name, folder, -1) if folder != "/" else name
    return _files(spark, path, glob).groupBy(below.alias("file_name")).agg(F.count("*").alias("n_rows"))


def first_files(spark: SparkSession, path: str, n: int, glob: str = "*.parquet") -> DataFrame:
    """Exploratory sample: the rows of the first ``n`` matching files by path. Only they are read."""
    files = _files(spark, path, glob)
    chosen = sorted(files.inputFiles())[:n]
    return spark.read.schema(files.schema).parquet(*chosen) if chosen else files


def distinct_users(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Distinct ``user_id`` over every matching file below ``root``."""
    return (
        spark.read.schema("user_id bigint")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .parquet(root)
        .distinct()
    )
