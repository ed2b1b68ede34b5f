"""Exact row positions without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.workspace import write_down


def number_rows(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (), output: str = "position"
) -> DataFrame:
    """0-based position of every row by ``order_by`` inside each ``within`` group.

    Rows are range-partitioned on group and order, so a large group spreads over many
    tasks. The sorted rows are written down with their task number, which freezes the
    split; positions then follow from one count per task and group, a table of at most
    (tasks + groups) rows, and never from a window over the rows. Only rows with equal
    order values stay together, so the order should tell rows apart.
    """
    keys = [*within, *order_by]
    laid_out = write_down(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_line", F.monotonically_increasing_id()),
        "numbered",
    ).table
    piece = [*within, "_task"]
    pieces = laid_out.groupBy(*piece).agg(F.count("*").alias("_rows"), F.min("_line").alias("_first"))
    before = Window.partitionBy(*within).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *piece, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    # Null groups are groups too.
    renamed = starts.select(*[F.col(c).alias(f"_of_{c}") for c in piece], "_shift")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in piece]
    return (
        laid_out.join(renamed, same)
        .withColumn(output, F.col("_line") + F.col("_shift"))
        .select(*within, *[c for c in df.columns if c not in within], output)
    )
