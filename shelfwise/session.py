"""Session construction.

The library itself never depends on these settings for correct results; they are
the ones that keep the plans healthy at scale.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level joins (clicks x orders, interactions x items) split a hot key at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str | None = None, **conf: str) -> SparkSession:
    """``local[n]`` with shuffle partitions matched to the cores."""
    cores = cores or os.cpu_count() or 4
    conf.setdefault("spark__sql__shuffle__partitions", str(cores))
    conf.setdefault("spark__ui__enabled", "false")
    conf.setdefault("spark__ui__showConsoleProgress", "false")
    conf.setdefault("spark__driver__memory", "8g")
    return build_session(master=f"local[{cores}]", **conf)
