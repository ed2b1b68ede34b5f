"""User features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.interactions import concat


def user_features(*trackers: DataFrame) -> DataFrame:
    """Distinct users over all splits."""
    return concat([t.select(F.col("user_id").cast("long").alias("user_id")) for t in trackers]).distinct()
