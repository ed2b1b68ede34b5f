"""What every fitted model is: user and item vectors whose dot product ranks items."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.ratings import top_items
from shelfwise.operators.recommend import dot_top_n, with_fallback
from shelfwise.sources.sinks import path_exists

PARTS = ("user_vectors", "item_vectors", "popularity")


@dataclass
class FactorModel:
    """``user_vectors(user_id, vector)``, ``item_vectors(item_id, vector)`` by external id.

    ``popularity(item_id, score)`` travels with the model, so fallback lists are the same
    before saving and after loading.
    """

    name: str
    user_vectors: DataFrame
    item_vectors: DataFrame
    popularity: DataFrame

    def recommend(self, users: DataFrame, n: int = 100) -> DataFrame:
        """``n`` items per user; items seen in training stay in. Unknown users get the popular list."""
        asked = users.select(F.col("user_id").cast("long").alias("user_id")).distinct()
        vectors = self.user_vectors.join(asked, "user_id", "left_semi")
        scored = dot_top_n(vectors, self.item_vectors, n)
        known = self.user_vectors.select(F.col("user_id").alias("ext_id"))
        return with_fallback(asked, scored, top_items(self.popularity, n, self.item_vectors), known)

    def save(self, root: str) -> str:
        """Write under ``root`` in a folder of its own, named by model, time and a run id; returns its path."""
        stamp = time.strftime("%Y%m%d_%H%M%S", time.gmtime())
        path = f"{root.rstrip('/')}/{self.name}_{stamp}_{uuid.uuid4().hex[:8]}"
        for part in PARTS:
            getattr(self, part).write.parquet(f"{path}/{part}")
        spark = self.user_vectors.sparkSession
        # Written last: a folder without it is not a complete model.
        spark.createDataFrame([(self.name,)], "name string").coalesce(1).write.json(f"{path}/meta")
        return path


def _newest_model(spark: SparkSession, root: str) -> str:
    """``root`` itself if it is a model, otherwise its most recent complete child."""
    if path_exists(spark, f"{root}/meta/_SUCCESS"):
        return root
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    children = list(files.listStatus(folder)) if files.exists(folder) else []
    complete = [c for c in children if c.isDirectory() and path_exists(spark, f"{c.getPath()}/meta/_SUCCESS")]
    if not complete:
        raise FileNotFoundError(f"no saved model under {root}")
    return str(max(complete, key=lambda c: (c.getModificationTime(), str(c.getPath()))).getPath())


def load_model(spark: SparkSession, root: str) -> FactorModel:
    path = _newest_model(spark, root.rstrip("/"))
    name = spark.read.schema("name string").json(f"{path}/meta").first()["name"]
    return FactorModel(name, *[spark.read.parquet(f"{path}/{part}") for part in PARTS])
