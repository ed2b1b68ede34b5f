"""Times the joins with hot keys on skewed logs: ``python trials_skew.py [rows] [cores]``.

A tenth of the users and one item of a hundred make up half of the events. Rows are made by
Spark, so their number is the only limit.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.functions.labels import rating_label, target_label  # noqa: E402
from shelfwise.operators import idmaps, interactions, ratings, sequences  # noqa: E402
from shelfwise.session import local_session  # noqa: E402

ACTIONS = ["favorite", "page_view", "to_cart", "view_description"]


def logs(spark, rows: int):
    part = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    hot = part(1, 2) == 0
    events = spark.range(rows).select(
        F.when(hot, part(2, rows // 2000 + 1)).otherwise(part(3, rows // 200 + 1)).alias("user_id"),
        F.when(hot, part(4, 10)).otherwise(part(5, 1000)).alias("item_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + part(6, 30 * 86_400)).alias("timestamp"),
        F.element_at(F.array(*map(F.lit, ACTIONS)), (part(7, 4) + 1).cast("int")).alias("action_type"),
    )
    bought = events.where("action_type = 'to_cart'").select(
        "user_id", "item_id", F.col("timestamp").alias("created_timestamp"),
        F.when(F.pmod("item_id", F.lit(4)) == 3, "canceled_orders").otherwise("delivered_orders").alias("last_status"),
        F.col("timestamp").alias("last_status_timestamp"),
    )
    return events, bought


def main(rows: int, cores: int) -> None:
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    clicks, bought = logs(spark, rows)
    users, items = (idmaps.id_map(c, clicks) for c in ("user_id", "item_id"))
    work = {
        "ratings": lambda: ratings.build_ratings(clicks, bought, rating_label("combined")),
        "inter_features": lambda: interactions.interaction_features(clicks, bought, target_label("delivered"), ACTIONS, ("7d", "1d")),
        "index_interactions": lambda: idmaps.index_interactions(clicks, users, items),
        "user_history": lambda: sequences.user_history(idmaps.index_interactions(interactions.basis(clicks), users, items), 50, block=rows // 50),
    }
    for name, make in work.items():
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s over {rows} events")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000, int(sys.argv[2]) if len(sys.argv) > 2 else 8)
