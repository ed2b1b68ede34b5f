"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.workspace import Written, discard, write_down


def components(links: DataFrame) -> Written:
    """``id, component`` for every end of ``links`` (``a, b``): the smallest id it reaches.

    Every round takes the smallest component among the neighbours and then the component of
    that component, so that chains halve; each is written down, so nothing is recomputed.
    """
    spark = links.sparkSession
    both = write_down(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    state = write_down(
        both.table.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")),
        "components",
    )
    while True:
        own = state.table
        near = both.table.join(own.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        low = own.join(near.withColumnRenamed("a", "id"), "id", "left").select(
            "id", F.col("component").alias("was"), F.least("component", "m").alias("component")
        )
        root = own.select(F.col("id").alias("component"), F.col("component").alias("root"))
        step = write_down(
            low.join(root, "component").select("id", F.least("component", "root").alias("component"), "was"), "components"
        )
        changed = step.table.where(F.col("component") != F.col("was")).limit(1).count()
        discard(spark, state.path)
        state = Written(step.table.select("id", "component"), step.path)
        if not changed:
            discard(spark, both.path)
            return state
