"""Times the headline queries and prints one JSON line.

Each query runs to completion into a sink that discards rows. The first run of a query
pays for code generation; the better of two is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.catalog.queries import QUERIES  # noqa: E402
from shelfwise.session import local_session  # noqa: E402

HEADLINE = [
    "tracker_orders_left",
    "split_time_user",
    "inter_features",
    "rolling_past",
    "item_features",
    "ratings",
    "id_map",
    "user_history",
    "batch_ids",
    "sequence_training_view",
    "label_corr",
    "cramers_v",
    "user_topn",
    "dot_topk",
    "recommend_with_fallback",
    "submission",
    "eval_popularity",
    "als_topn",  # trains by MLlib; als_eval, timed here before, now judges a model that SQL can state
    "bpr_topn",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS") or os.cpu_count())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["eval_popularity"](spark, sf_dir).collect()
    times = {name: round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
