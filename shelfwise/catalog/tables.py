"""The given tables in the shape of click, order and item logs.

Every event is a click on the item named in its properties; purchases are orders too,
one in three reaching its last status a day later, one in four cancelled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Split edges inside the generated month, in epoch seconds.
TRAIN_END = 1_705_363_200
VALID_END = 1_706_659_200

# Event types of the given table and the actions they stand for.
ACTION_OF_EVENT = {
    "view": "page_view",
    "click": "view_description",
    "signup": "favorite",
    "purchase": "to_cart",
}
OTHER_ACTION = "remove"
ACTIONS = sorted([*ACTION_OF_EVENT.values(), OTHER_ACTION])

# Schemas are stated, so that planning a query starts no job to look into files.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "embeddings": "vec_id bigint, embedding array<float>",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderpriority string",
}
_ITEM_ID = "CAST(get_json_object(props, '$.k') AS BIGINT) AS item_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = " ".join(f"WHEN '{event}' THEN '{action}'" for event, action in ACTION_OF_EVENT.items())
    return table(spark, sf_dir, "events").selectExpr(
        "user_id",
        _ITEM_ID,
        "ts AS timestamp",
        f"CASE event_type {known} ELSE '{OTHER_ACTION}' END AS action_type",
        "event_type AS action_widget",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(
        "user_id",
        _ITEM_ID,
        "ts AS created_timestamp",
        "CASE WHEN event_id % 4 = 3 THEN 'canceled_orders' ELSE 'delivered_orders' END AS last_status",
        "CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS last_status_timestamp",
    )


def _attribute(name: str, value: str, aspect: bool) -> str:
    return (
        f"named_struct('attribute_name', '{name}', 'attribute_value', {value}, "
        f"'attribute_isaspect', {aspect}, 'attribute_showascharacteristic', {not aspect})"
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, vectors = table(spark, sf_dir, "part"), table(spark, sf_dir, "embeddings")
    attributes = ", ".join(
        [
            _attribute("Type", "p_type", False),
            _attribute("Brand", "p_brand", False),
            _attribute("ColorBase", "split(p_name, ' ')[0]", True),
            _attribute("Material", "split(p_name, ' ')[1]", True),
        ]
    )
    return part.join(vectors, part["p_partkey"] == vectors["vec_id"], "left").selectExpr(
        "p_partkey AS item_id",
        "p_size AS catalogid",
        "p_partkey % 97 AS variant_id",
        "p_partkey % 31 AS model_id",
        "p_name AS itemname",
        "embedding AS fclip_embed",
        f"CASE WHEN p_size > 45 THEN slice(array({attributes}), 1, 0) ELSE array({attributes}) END AS attributes",
    )
