"""Implicit-feedback matrix factorisation (Hu, Koren, Volinsky 2008) with MLlib."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.models.factors import FactorModel
from shelfwise.operators.idmaps import index_interactions
from shelfwise.operators.ratings import popularity_by_weight
from shelfwise.workspace import checkpoint_root, discard, write_down

# Fixed value: MLlib's own number of blocks. Start values are drawn per block, so it is part of the model.
BLOCKS = 10


def fit_als(
    ratings: DataFrame,
    user_map: DataFrame,
    item_map: DataFrame,
    factors: int = 128,
    regularization: float = 0.01,
    iterations: int = 30,
    alpha: float = 1.0,
    blocks: int = BLOCKS,
    seed: int = 42,
) -> FactorModel:
    """Factorise ``(user_id, item_id, rating)``.

    MLlib wants ids in the int range, hence the dense maps. Raise ``blocks`` with the data
    (about 10 million ratings a block): it is a parameter, never taken from the cluster,
    so that a model does not depend on where it was trained. MLlib weighs an observation by
    1 + ``alpha`` * rating and scales ``regularization`` by the ratings of each user and
    item. Lineage is cut every ten iterations in the shared checkpoint folder. Mapped items
    without a rating get the zero vector, which scores 0 for everyone.
    """
    spark = ratings.sparkSession
    checkpoint_root(spark)
    # MLlib goes over its input more than once, and its factors hang on it until written.
    indexed = write_down(
        index_interactions(ratings, user_map, item_map).select(
            F.col("user_idx").cast("int").alias("user"), F.col("item_idx").cast("int").alias("item"), "rating"
        ),
        "als-ratings",
    )
    fitted = ALS(
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        implicitPrefs=True,
        rank=factors,
        regParam=regularization,
        maxIter=iterations,
        alpha=alpha,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=10,
        seed=seed,
    ).fit(indexed.table)

    def external(vectors: DataFrame, ids: DataFrame, name: str, how: str) -> DataFrame:
        zero = F.array_repeat(F.lit(0.0).cast("float"), factors)
        named = ids.join(vectors, F.col("idx") == F.col("id"), how).select(
            F.col("ext_id").alias(name), F.coalesce("features", zero).alias("vector")
        )
        return write_down(named, f"als-{name}").table

    model = FactorModel(
        "als",
        external(fitted.userFactors, user_map, "user_id", "inner"),
        external(fitted.itemFactors, item_map, "item_id", "left"),
        popularity_by_weight(ratings),
    )
    discard(spark, indexed.path)
    return model
