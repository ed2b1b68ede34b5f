"""One query per operator, over the given tables as click, order and item logs.

Every query covers whole tables. Results are in a form both engines print alike:
dates as text, flags and counts as 64-bit integers, doubles with six digits, lists as
joined text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.catalog.tables import ACTIONS, TRAIN_END, VALID_END, items, orders, table, tracker
from shelfwise.functions import expressions as ex
from shelfwise.functions import labels
from shelfwise.models import bpr, equations
from shelfwise.models.factors import FactorModel, load_model
from shelfwise.models.registry import fit_model
from shelfwise.operators import association, evaluate, hot, idmaps, interactions, ratings, recommend, sequences, splits
from shelfwise.operators import items as item_ops
from shelfwise.operators.users import user_features
from shelfwise.plans.jobs import SplitSettings, judge_popularity
from shelfwise.sources import bucketed, commits, scans, sinks
from shelfwise.workspace import run_folder

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL.
WINDOWS = ("14d", "7d", "1d")
INTEREST = ("favorite", "to_cart", "view_description")
HISTORY = 10
KS = (5, 10, 20)
SHARDS = 16
BATCH = 64

QUERIES: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType
        text = name
        if isinstance(kind, T.DateType):
            text = f"date_format({name}, 'yyyy-MM-dd')"
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')"
        elif isinstance(kind, (T.BooleanType, T.IntegralType)):
            text = f"CAST({name} AS BIGINT)"
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            text = f"round(CAST({name} AS DOUBLE), 6) + 0D"
        elif isinstance(kind, T.ArrayType):
            entry = "v"
            if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
                entry = "CAST(round(CAST(v AS DOUBLE) * 1000000D, 0) AS BIGINT)"
            text = f"array_join(transform({name}, v -> CAST({entry} AS STRING)), ' ')"
        return f"{text} AS {name}"

    return df.selectExpr(*[column(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _log_rows(df: DataFrame, ts: str, **names: str) -> DataFrame:
    tags = [F.lit(v).alias(k) for k, v in names.items()]
    return df.select(*tags, "user_id", "item_id", ex.epoch_seconds(df, ts).alias("sec"))


def _train_tracker(spark, d) -> DataFrame:
    return splits.time_split(tracker(spark, d), "timestamp", TRAIN_END, VALID_END).train


def _orders_split(spark, d) -> splits.Split:
    return splits.time_split(orders(spark, d), "created_timestamp", TRAIN_END, VALID_END)


def _train_ratings(spark, d, label: str = "combined") -> DataFrame:
    return ratings.build_ratings(_train_tracker(spark, d), _orders_split(spark, d).train, labels.rating_label(label))


def _truth(spark, d) -> DataFrame:
    return ratings.truth_from_orders(_orders_split(spark, d).valid)


def _all_users(spark, d) -> DataFrame:
    return tracker(spark, d).select("user_id").distinct()


def _asked_users(spark, d) -> DataFrame:
    """Users that recommendations are asked for; many of them never clicked."""
    return table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))


def _train_users(spark, d) -> DataFrame:
    return idmaps.id_map("user_id", _train_tracker(spark, d))


def _popular(spark, d, n: int) -> DataFrame:
    """The most popular of all items of the training log."""
    mapped = idmaps.distinct_ids("item_id", _train_tracker(spark, d)).withColumnRenamed("ext_id", "item_id")
    return ratings.top_items(ratings.popularity_by_weight(_train_ratings(spark, d)), n, mapped)


def _pair_features(spark, d) -> DataFrame:
    return association.pair_features(orders(spark, d), tracker(spark, d), ACTIONS)


def _history(spark, d) -> DataFrame:
    log = tracker(spark, d)
    users, things = idmaps.id_map("user_id", log), idmaps.id_map("item_id", log)
    rows = interactions.basis(log)
    # Raw events per user are at least the distinct rows, and cheaper to count.
    heavy = sequences.heavy_indices(log, users)
    return sequences.user_history(idmaps.index_interactions(rows, users, things), HISTORY, heavy=heavy)


def _features(spark, d, **options) -> DataFrame:
    return interactions.interaction_features(
        tracker(spark, d), orders(spark, d), labels.target_label("delivered"), ACTIONS, WINDOWS, **options
    )


def _frequency(spark, d, share: float) -> DataFrame:
    things = items(spark, d)
    return item_ops.attribute_frequency(item_ops.item_attributes(things), things.count(), share)


# ---- scans and sinks ----


@query
def scan_project(spark, d):
    return scans.scan_selected(spark, f"{d}/events.parquet", ["event_id", "user_id", "event_type"])


@query
def scan_glob_counts(spark, d):
    return scans.rows_per_file(spark, d, "{customer,events,orders,part}.parquet")


@query
def test_users(spark, d):
    return scans.distinct_users(spark, d, "events.parquet")


@query
def shard_counts(spark, d):
    return sinks.shard_counts(tracker(spark, d), "user_id", 64)


@query
def submission(spark, d):
    scored = _train_ratings(spark, d).withColumnRenamed("rating", "score")
    mine = recommend.top_n(scored, 100)
    listed = recommend.with_fallback(_asked_users(spark, d), mine, _popular(spark, d, 100), _train_users(spark, d))
    return sinks.submission(listed, 100)


@query
def infer_submission(spark, d):
    """A model of given vectors, stored and loaded, asked for every customer."""
    vectors = table(spark, d, "embeddings")
    things = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    users = vectors.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vector"))
    popularity = ratings.popularity_by_weight(_train_ratings(spark, d))
    path = FactorModel("given", users, things, popularity).save(f"{run_folder(spark)}/models")
    return sinks.submission(load_model(spark, path).recommend(_asked_users(spark, d), 20), 20)


@query
def commit_log(spark, d):
    """A table of training clicks that is replaced by one of all clicks: its manifest, and what each version holds."""
    path = f"{run_folder(spark)}/commit-log-{uuid.uuid4().hex}"
    log = tracker(spark, d).select("user_id", "item_id")
    for rows in (_train_tracker(spark, d).select("user_id", "item_id"), log):
        sinks.write_sharded_part(rows, path, shards=SHARDS)
    parts = [
        commits.read(spark, path, e.version).agg(
            F.lit(e.number).cast("long").alias("entry"),
            F.lit(e.rows).cast("long").alias("n_noted"),
            F.count("*").alias("n_rows"),
            F.count_distinct(sinks.SHARD).alias("n_shards"),
        )
        for e in commits.entries(spark, path)
    ]
    return interactions.concat(parts)


@query
def metrics_json(spark, d):
    """Metrics as the flat JSON object that a training run leaves, read back."""
    path = f"{run_folder(spark)}/metrics-{uuid.uuid4().hex}"
    mine = recommend.top_n(_train_ratings(spark, d).withColumnRenamed("rating", "score"), 20)
    sinks.write_metrics(evaluate.evaluate(mine, _truth(spark, d), KS), path)
    wide = spark.read.json(path)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in wide.columns])))


# ---- expressions ----


@query
def item_base(spark, d):
    return item_ops.item_base(items(spark, d))


@query
def epoch_filter(spark, d):
    log = tracker(spark, d)
    late = log.where(ex.epoch_after(log, "timestamp", TRAIN_END))
    return _log_rows(late, "timestamp")


@query
def user_bucket(spark, d):
    ids = _all_users(spark, d)
    return ids.select(
        "user_id",
        ex.user_bucket("user_id", 800, 17).alias("bucket"),
        ex.user_bucket(-F.col("user_id") - 40, 800, 17).alias("bucket_of_negative"),
    )


@query
def coerce_features(spark, d):
    table = items(spark, d).withColumn(
        "day_text", F.concat(F.lit("2024-01-"), F.lpad(F.col("catalogid").cast("string"), 2, "0"))
    )
    size = F.col("catalogid").cast("string")
    table = table.withColumn("mixed_text", F.when(F.col("catalogid") < 25, size).otherwise(F.col("itemname")))
    return table.select(
        "item_id",
        ex.coerce_value(table, "catalogid", "float").alias("as_float"),
        ex.coerce_value(table, "variant_id", "token_seq").alias("as_token_seq"),
        ex.coerce_value(table, "mixed_text", "token").alias("as_token"),
        ex.coerce_value(table, "fclip_embed", "float").alias("first_component"),
        ex.coerce_value(table, "fclip_embed", "float_seq").alias("as_float_seq"),
        ex.lenient_label("mixed_text").alias("label"),
        ex.lenient_day(table, "day_text").alias("day"),
    )


@query
def safe_attr_names(spark, d):
    values = item_ops.item_attributes(items(spark, d)).select("attr_value")
    priorities = table(spark, d, "orders").select(F.col("o_orderpriority").alias("attr_value"))
    texts = values.unionByName(priorities).distinct()
    return texts.select("attr_value", ex.safe_name_of("attr_value").alias("safe"))


@query
def item_attrs_long(spark, d):
    return item_ops.item_attributes(items(spark, d))


@query
def labels_all(spark, d):
    joined = interactions.join_tracker_orders(tracker(spark, d), orders(spark, d))
    rating = [label.column().alias(name) for name, label in labels.RATING_LABELS.items()]
    target = [label.column().alias(f"target_{name}") for name, label in labels.TARGET_LABELS.items()]
    return joined.select("user_id", "item_id", "date", "action_type", "last_status", *rating, *target)


@query
def label_selector(spark, d):
    """Every label, chosen by name, summed over the joined events."""
    joined = interactions.join_tracker_orders(tracker(spark, d), orders(spark, d))
    chosen = [("rating", n, labels.rating_label(n)) for n in labels.RATING_LABELS]
    chosen += [("target", n, labels.target_label(n)) for n in labels.TARGET_LABELS]
    sums = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("label"),
            F.sum(label.column().cast("double")).alias("total"), F.count(label.column()).alias("n_known"),
        )
        for kind, name, label in chosen
    ]
    return joined.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


# ---- splits ----


def _split_rows(spark, d, kind: str, **params) -> DataFrame:
    parts = []
    for name, df, ts in (
        ("tracker", tracker(spark, d), "timestamp"),
        ("orders", orders(spark, d), "created_timestamp"),
    ):
        split = splits.make_split(df, ts, kind, **params)
        parts.append(_log_rows(split.train, ts, table_name=name, split="train"))
        if split.valid is not None:
            parts.append(_log_rows(split.valid, ts, table_name=name, split="valid"))
    return interactions.concat(parts)


@query
def split_time(spark, d):
    return _split_rows(spark, d, "time_split", train_end=TRAIN_END, valid_end=VALID_END)


@query
def split_time_user(spark, d):
    return _split_rows(
        spark, d, "time_user_split", train_end=TRAIN_END, valid_end=VALID_END, valid_ratio=0.1, mod=800, seed=17
    )


@query
def split_only_train(spark, d):
    return _split_rows(spark, d, "only_train")


@query
def split_fast_users(spark, d):
    users = splits.first_users(orders(spark, d), 25)
    kept = splits.keep_users(tracker(spark, d), users, 25)
    bought = splits.keep_users(orders(spark, d), users, 25)
    return _log_rows(kept, "timestamp", table_name="tracker").unionByName(
        _log_rows(bought, "created_timestamp", table_name="orders")
    )


@query
def valid_users(spark, d):
    return splits.cap_users(_truth(spark, d), 100)


# ---- joins ----


@query
def tracker_orders_left(spark, d):
    joined = interactions.join_tracker_orders(tracker(spark, d), orders(spark, d))
    sec = ex.epoch_seconds(joined, "timestamp").alias("sec")
    return joined.select("user_id", "item_id", "date", sec, "action_type", "last_status")


def _bucketed_days(spark, d) -> tuple[DataFrame, DataFrame]:
    """Clicks and orders, stored by day, user and item, and read again."""
    root = f"{run_folder(spark)}/days-{uuid.uuid4().hex}"
    tables = {}
    for name, rows in zip(("clicks", "orders"), interactions.by_day(tracker(spark, d), orders(spark, d))):
        bucketed.write_bucketed(rows, f"{root}/{name}", interactions.DAY_KEYS, SHARDS)
        tables[name] = bucketed.read_bucketed(spark, f"{root}/{name}")
    return tables["clicks"], tables["orders"]


@query
def tracker_orders_bucketed(spark, d):
    joined = interactions.join_days(*_bucketed_days(spark, d))
    sec = ex.epoch_seconds(joined, "timestamp").alias("sec")
    return joined.select("user_id", "item_id", "date", sec, "action_type", "last_status")


@query
def inter_features_bucketed(spark, d):
    """The feature table from stored days: one shuffle, by pair."""
    logs = interactions.as_logs(*_bucketed_days(spark, d))
    return interactions.interaction_features(*logs, labels.target_label("delivered"), ACTIONS, WINDOWS)


@query
def inter_features(spark, d):
    return _features(spark, d)


@query
def inter_features_horizon(spark, d):
    return _features(spark, d, horizon_days=3, drop_duplicate_targets=False)


HOT_SHARE = 0.0105


def _view(spark, d, hot_share: float | None = None) -> DataFrame:
    users = table(spark, d, "customer").withColumnRenamed("c_custkey", "user_id")
    inter = _features(spark, d).select("date", "user_id", "item_id", "target", "cnt_to_cart_sum_7d_past")
    return sequences.training_view(
        inter,
        item_ops.item_base(items(spark, d)),
        ["catalogid", "variant_id", "model_id"],
        users,
        ["c_nationkey", "c_mktsegment"],
        hot_share,
    )


@query
def training_view(spark, d):
    return _view(spark, d)


@query
def training_view_hot(spark, d):
    """The training view, its hot ids joined apart."""
    return _view(spark, d, HOT_SHARE)


@query
def training_view_pos(spark, d):
    return sequences.positive_view(_view(spark, d))


@query
def interactions_indexed(spark, d):
    train = _train_tracker(spark, d)
    users, things = idmaps.id_map("user_id", train), idmaps.id_map("item_id", train)
    return idmaps.index_interactions(interactions.basis(tracker(spark, d)), users, things)


@query
def interactions_indexed_hot(spark, d):
    """Indexed interactions, their hot ids joined apart."""
    train = _train_tracker(spark, d)
    users, things = idmaps.id_map("user_id", train), idmaps.id_map("item_id", train)
    return idmaps.index_interactions(interactions.basis(tracker(spark, d)), users, things, HOT_SHARE)


@query
def hot_items(spark, d):
    """Items with more than their share of all clicks."""
    return hot.hot_ids(tracker(spark, d), "item_id", HOT_SHARE, exact=True)


@query
def item_attrs_frequent(spark, d):
    attributes = item_ops.item_attributes(items(spark, d))
    return item_ops.frequent_attributes(attributes, _frequency(spark, d, 0.04), 0.04)


@query
def pair_features(spark, d):
    return _pair_features(spark, d)


@query
def cold_users(spark, d):
    users, known = _asked_users(spark, d), _train_users(spark, d)
    warm = recommend.known_users(users, known).withColumn("is_known", F.lit(True))
    return warm.unionByName(recommend.cold_users(users, known).withColumn("is_known", F.lit(False)))


@query
def item_features(spark, d):
    return item_ops.item_features(items(spark, d), 0.01).drop("fclip_embed")


# ---- aggregates ----


@query
def basis(spark, d):
    return interactions.basis(tracker(spark, d))


@query
def daily_actions(spark, d):
    return interactions.daily_actions(tracker(spark, d))


@query
def daily_actions_wide(spark, d):
    return interactions.daily_actions_wide(tracker(spark, d), ACTIONS)


@query
def daily_actions_map(spark, d):
    days = interactions.daily_actions_map(tracker(spark, d))
    told = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return days.select(*interactions.DAY_KEYS, F.array_join(told, " ").alias("counts"))


@query
def pair_actions_pivot(spark, d):
    return association.pair_actions(tracker(spark, d), ACTIONS)


@query
def first_positive(spark, d):
    return interactions.first_positive(tracker(spark, d), orders(spark, d), labels.target_label("delivered"))


def _horizon(spark, d) -> DataFrame:
    log = tracker(spark, d)
    first = interactions.first_positive(log, orders(spark, d), labels.target_label("combined"))
    return interactions.horizon_target(interactions.basis(log), first, 3)


@query
def target_horizon(spark, d):
    return _horizon(spark, d)


@query
def target_dedup(spark, d):
    return interactions.dedup_target(_horizon(spark, d))


@query
def attr_frequency(spark, d):
    return _frequency(spark, d, 0.04)


def _frequent_values(spark, d, share: float) -> item_ops.FrequentValues:
    return item_ops.frequent_values(_frequency(spark, d, share))


@query
def attr_main(spark, d):
    return item_ops.main_values(item_ops.item_attributes(items(spark, d)), _frequent_values(spark, d, 0.03))


@query
def attr_multihot(spark, d):
    return item_ops.flag_features(item_ops.item_attributes(items(spark, d)), _frequent_values(spark, d, 0.01))


def _dictionary(spark, d) -> DataFrame:
    return item_ops.attribute_dictionary(item_ops.item_attributes(items(spark, d)))


@query
def attr_dictionary(spark, d):
    return _dictionary(spark, d)


@query
def attr_sparse(spark, d):
    """Ids of all attribute values of an item, without a cut."""
    return item_ops.sparse_attributes(item_ops.item_attributes(items(spark, d)), _dictionary(spark, d))


@query
def item_features_sparse(spark, d):
    return item_ops.item_features_sparse(items(spark, d), _dictionary(spark, d), ("Type", "Brand")).drop("fclip_embed")


@query
def attr_counts(spark, d):
    table = items(spark, d)
    return item_ops.attribute_counts(table, item_ops.item_attributes(table))


@query
def ratings_weighted(spark, d):
    return _train_ratings(spark, d)


@query
def ratings_binary(spark, d):
    return ratings.binarise(_train_ratings(spark, d, "delivered"))


@query
def popularity_weight(spark, d):
    return ratings.popularity_by_weight(_train_ratings(spark, d))


@query
def popularity_count(spark, d):
    return ratings.popularity_by_count(interactions.basis(_train_tracker(spark, d)))


@query
def value_counts(spark, d):
    return association.value_counts(tracker(spark, d), "action_widget", more_than=1000)


@query
def time_bounds(spark, d):
    clicks = association.time_bounds(tracker(spark, d), "timestamp").withColumn("table_name", F.lit("tracker"))
    bought = association.time_bounds(orders(spark, d), "created_timestamp").withColumn("table_name", F.lit("orders"))
    return clicks.unionByName(bought)


@query
def last_status(spark, d):
    return association.last_status(orders(spark, d))


@query
def dedup_keep_last(spark, d):
    log = orders(spark, d).select("user_id", "item_id", "created_timestamp", "last_status")
    return association.last_row(log, ["user_id", "item_id"], ["created_timestamp"]).drop("created_timestamp")


@query
def users_distinct(spark, d):
    split = splits.time_split(tracker(spark, d), "timestamp", TRAIN_END, VALID_END)
    return user_features(split.train, split.valid)


@query
def signal_rates(spark, d):
    return association.signal_rates(_pair_features(spark, d), ACTIONS)


@query
def any_signal_rate(spark, d):
    return association.any_signal_rate(_pair_features(spark, d), INTEREST)


# ---- windows and sequences ----


def _rolling(spark, d, direction: str) -> DataFrame:
    daily = interactions.daily_actions_wide(tracker(spark, d), ACTIONS)
    return interactions.rolling_actions(daily, ACTIONS, WINDOWS, direction)


@query
def rolling_forward(spark, d):
    return _rolling(spark, d, "forward")


@query
def rolling_past(spark, d):
    return _rolling(spark, d, "past")


@query
def rolling_stacked(spark, d):
    return interactions.stack_windows(_rolling(spark, d, "forward"), ACTIONS, WINDOWS)


@query
def user_history(spark, d):
    return _history(spark, d)


@query
def user_history_padded(spark, d):
    told = _history(spark, d)
    padded = sequences.pad_left("item_id_list", HISTORY + 2).alias("padded")
    return told.select("user_id", "item_id", "date", padded)


@query
def float_seq_padded(spark, d):
    vectors = table(spark, d, "embeddings")
    return vectors.select("vec_id", sequences.pad_left("embedding", 70, kind="float").alias("padded"))


@query
def batch_ids(spark, d):
    return sequences.with_batches(interactions.basis(tracker(spark, d)), SHARDS, BATCH)


# ---- top-n and sets ----


@query
def popular_topn(spark, d):
    return _popular(spark, d, 20)


@query
def user_topn(spark, d):
    return recommend.top_n(_train_ratings(spark, d).withColumnRenamed("rating", "score"), 10)


@query
def label_corr(spark, d):
    return association.label_correlation(_pair_features(spark, d), ACTIONS)


@query
def union_splits(spark, d):
    split = splits.time_split(tracker(spark, d), "timestamp", TRAIN_END, VALID_END)
    return _log_rows(interactions.concat([split.train, split.valid]), "timestamp")


@query
def union_relaxed(spark, d):
    daily = interactions.daily_actions(tracker(spark, d))
    outcomes = interactions.daily_outcomes(orders(spark, d))
    return interactions.concat_relaxed([daily, outcomes])


@query
def id_map(spark, d):
    split = splits.time_split(tracker(spark, d), "timestamp", TRAIN_END, VALID_END)
    users = idmaps.id_map("user_id", split.train, split.valid).withColumn("kind", F.lit("user"))
    return users.unionByName(idmaps.id_map("item_id", split.train, split.valid).withColumn("kind", F.lit("item")))


# ---- recommending and judging ----


@query
def recommend_with_fallback(spark, d):
    mine = recommend.top_n(_train_ratings(spark, d).withColumnRenamed("rating", "score"), 20)
    return recommend.with_fallback(_asked_users(spark, d), mine, _popular(spark, d, 20), _train_users(spark, d))


@query
def fallback_by_position(spark, d):
    cold = recommend.cold_users(_asked_users(spark, d), _train_users(spark, d))
    return recommend.popular_lists(cold, recommend.by_position(_popular(spark, d, 20), 20))


@query
def dot_topk(spark, d):
    vectors = table(spark, d, "embeddings")
    users = vectors.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vector"))
    things = vectors.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return recommend.dot_top_n(users, things, 10)


@query
def ground_truth(spark, d):
    return _truth(spark, d)


@query
def ground_truth_features(spark, d):
    return ratings.truth_from_features(_features(spark, d, drop_duplicate_targets=False))


@query
def eval_metrics(spark, d):
    mine = recommend.top_n(_train_ratings(spark, d).withColumnRenamed("rating", "score"), 20)
    return evaluate.evaluate(mine, _truth(spark, d), KS)


@query
def eval_popularity(spark, d):
    settings = SplitSettings(TRAIN_END, VALID_END)
    return judge_popularity(tracker(spark, d), orders(spark, d), settings, "combined", KS)


@query
def sequence_training_view(spark, d):
    log = tracker(spark, d)
    return sequences.sequence_training_view(
        _features(spark, d).select("date", "user_id", "item_id", "target", "cnt_to_cart_sum_7d_past"),
        idmaps.id_map("user_id", log),
        idmaps.id_map("item_id", log),
        {"catalogid": "token", "variant_id": "token", "fclip_embed": "float", "cnt_to_cart_sum_7d_past": "float"},
        item_ops.item_base(items(spark, d)),
        ["catalogid", "variant_id", "fclip_embed"],
        length=HISTORY,
    )


@query
def dataset_stats(spark, d):
    train = _train_tracker(spark, d)
    users, things = idmaps.distinct_ids("user_id", train), idmaps.distinct_ids("item_id", train)
    return ratings.dataset_stats(_train_ratings(spark, d), users, things, _truth(spark, d))


def _positives(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    train = _train_tracker(spark, d)
    users, things = idmaps.id_map("user_id", train), idmaps.id_map("item_id", train)
    pairs = idmaps.index_interactions(_train_ratings(spark, d, "delivered"), users, things)
    return pairs.select("user_idx", "item_idx"), users, things


@query
def bpr_triples_drawn(spark, d):
    pairs, _, things = _positives(spark, d)
    return bpr.bpr_triples(pairs, things.count())


def _fitted(spark, d, name: str, label: str, **params):
    train = _train_tracker(spark, d)
    users, things = idmaps.id_map("user_id", train), idmaps.id_map("item_id", train)
    return fit_model(name, _train_ratings(spark, d, label), users, things, **params)


def _list_facts(lists: DataFrame, known: DataFrame) -> DataFrame:
    """What must hold of every user's list whatever the model has learnt, and cold users' lists in full."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    per_user = lists.groupBy("user_id").agg(entries.alias("_l")).join(
        known.select(F.col("ext_id").alias("user_id"), F.lit(True).alias("_known")), "user_id", "left"
    )
    falls = F.forall(
        F.sequence(F.lit(1), F.size("_l")),
        lambda i: (i == 1) | (F.get("_l", i - 1)["score"] <= F.get("_l", F.greatest(i - 2, F.lit(0)))["score"]),
    )
    return per_user.select(
        "user_id",
        F.size("_l").alias("n_items"),
        F.size(F.array_distinct(F.transform("_l", lambda e: e["item_id"]))).alias("n_distinct"),
        F.get("_l", F.lit(0))["rank"].alias("first_rank"),
        F.get("_l", F.size("_l") - 1)["rank"].alias("last_rank"),
        falls.alias("falls"),
        F.when(F.col("_known").isNull(), F.array_join(F.transform("_l", lambda e: e["item_id"].cast("string")), " ")).alias("cold_list"),
    )


def als_model(spark, d):
    return _fitted(spark, d, "als", "combined", factors=8, iterations=5)


def bpr_model(spark, d):
    return _fitted(spark, d, "bpr", "delivered", factors=8, iterations=3, learning_rate=0.1)


@query
def als_topn(spark, d):
    """Facts of the lists of every customer; ratings decide who has a vector."""
    model = als_model(spark, d)
    known = model.user_vectors.select(F.col("user_id").alias("ext_id"))
    return _list_facts(model.recommend(_asked_users(spark, d), 20), known)


REGULARIZATION, ALPHA = 0.05, 0.5


def _train_maps(spark, d) -> tuple[DataFrame, DataFrame]:
    train = _train_tracker(spark, d)
    return idmaps.id_map("user_id", train), idmaps.id_map("item_id", train)


def _drawn(ids: DataFrame, side: int, factors: int, name: str) -> DataFrame:
    """Start vectors by external id, without the bias."""
    vectors = ids.join(bpr.drawn_vectors(ids, side, factors), "idx")
    return vectors.select(F.col("ext_id").alias(name), F.slice("vector", 1, factors).alias("vector"))


@query
def als_residuals(spark, d):
    """How far drawn vectors are from solving the normal equations of every rated user, and their loss."""
    users, things = _train_maps(spark, d)
    return equations.normal_equation_residuals(
        _train_ratings(spark, d), _drawn(users, bpr.USER, 4, "user_id"), _drawn(things, bpr.ITEM, 4, "item_id"), REGULARIZATION, ALPHA
    )


def _half_step(spark, d) -> FactorModel:
    """A stored model: drawn item vectors, and the user vectors that solve the normal equations for them."""
    _, things = _train_maps(spark, d)
    rated, vectors = _train_ratings(spark, d), _drawn(things, bpr.ITEM, 2, "item_id")
    solved = equations.solve_users(rated, vectors, REGULARIZATION, ALPHA)
    path = FactorModel("half", solved, vectors, ratings.popularity_by_weight(rated)).save(f"{run_folder(spark)}/half-{uuid.uuid4().hex}")
    return load_model(spark, path)


@query
def als_half_step(spark, d):
    return _half_step(spark, d).user_vectors


@query
def als_lists(spark, d):
    """Lists of a stored model for all validation users."""
    return _half_step(spark, d).recommend(splits.cap_users(_truth(spark, d), None), 20)


@query
def als_eval(spark, d):
    """Recall and NDCG of a stored model over all validation users."""
    truth = _truth(spark, d)
    return evaluate.evaluate(_half_step(spark, d).recommend(splits.cap_users(truth, None), 100), truth, KS)


def _first_step(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drawn triples, start vectors, and the vectors after one step."""
    pairs, users, things = _positives(spark, d)
    triples = bpr.bpr_triples(pairs, things.count())
    start = bpr.drawn_vectors(users, bpr.USER, 4).unionByName(bpr.drawn_vectors(things, bpr.ITEM, 4))
    return triples, start, bpr.gradient_step(start, triples, 0.5, 0.01)


@query
def bpr_first_step(spark, d):
    return _first_step(spark, d)[2]


@query
def bpr_losses(spark, d):
    """Mean pairwise loss before and after the step."""
    triples, start, stepped = _first_step(spark, d)
    before = bpr.pairwise_loss(start, triples).withColumn("moment", F.lit("start"))
    return before.unionByName(bpr.pairwise_loss(stepped, triples).withColumn("moment", F.lit("after")))


@query
def bpr_topn(spark, d):
    model = bpr_model(spark, d)
    known = model.user_vectors.select(F.col("user_id").alias("ext_id"))
    return _list_facts(model.recommend(_asked_users(spark, d), 20), known)


# ---- association ----


@query
def contingency(spark, d):
    return association.contingency(tracker(spark, d), orders(spark, d))


@query
def pearson_residuals(spark, d):
    cells = association.cell_statistics(association.contingency(tracker(spark, d), orders(spark, d)))
    return cells.select("action_type", "last_status", "observed", "expected", "residual")


@query
def pmi(spark, d):
    cells = association.cell_statistics(association.contingency(tracker(spark, d), orders(spark, d)))
    return cells.select("action_type", "last_status", "pmi")


@query
def cramers_v(spark, d):
    return association.cramers_v(association.contingency(tracker(spark, d), orders(spark, d)))


# Names taken by functions used above.
QUERIES["ratings"] = QUERIES.pop("ratings_weighted")
QUERIES["user_features"] = QUERIES.pop("users_distinct")
QUERIES["bpr_triples"] = QUERIES.pop("bpr_triples_drawn")
