"""Joins that shuffle nothing, joins that gather no hot id, and features that need no column per value."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from shelfwise.catalog import tables
from shelfwise.functions import labels
from shelfwise.operators import hot, idmaps, interactions, items, sequences
from shelfwise.plans import jobs
from shelfwise.sources import bucketed, commits

ACTIONS = ["favorite", "page_view", "remove", "review_view", "to_cart", "unfavorite", "view_description"]


@pytest.fixture()
def plain_joins(spark):
    """No broadcast by size and no adaptive plans, so that the plan shows what would run on large tables."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def days(spark, tmp_path, clicks, bought):
    for name, rows in zip(("clicks", "orders"), interactions.by_day(clicks, bought)):
        bucketed.write_bucketed(rows, f"{tmp_path}/{name}", interactions.DAY_KEYS, 4)
    return [f"{tmp_path}/{name}" for name in ("clicks", "orders")]


def test_bucketed_join_shuffles_nothing(spark, days, clicks, bought, plain_joins):
    joined = interactions.join_days(*[bucketed.read_bucketed(spark, p) for p in days])
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    columns = ["user_id", "item_id", "date", "timestamp", "action_type", "last_status"]
    plainly = interactions.join_tracker_orders(clicks, bought)
    assert sorted(map(tuple, joined.select(columns).collect()), key=repr) == sorted(map(tuple, plainly.select(columns).collect()), key=repr)
    assert plan(plainly).count("Exchange") == 2


def test_features_from_days_take_one_shuffle(spark, days, clicks, bought, plain_joins):
    logs = interactions.as_logs(*[bucketed.read_bucketed(spark, p) for p in days])
    label = labels.target_label("delivered")
    mine = interactions.interaction_features(*logs, label, ACTIONS)
    assert plan(mine).count("Exchange hashpartitioning") == 1
    plainly = interactions.interaction_features(clicks, bought, label, ACTIONS)
    assert as_set(mine) == as_set(plainly)
    assert plan(plainly).count("Exchange hashpartitioning") == 3


def test_another_session_knows_the_buckets(spark, days, plain_joins):
    entry = commits.newest(spark, days[0])
    assert entry.facts == {"keys": list(interactions.DAY_KEYS), "buckets": 4}
    spark.sql(f"DROP TABLE {bucketed._name(entry.version)}")
    assert "Exchange" not in plan(bucketed.read_bucketed(spark, days[0]).groupBy(*interactions.DAY_KEYS).count())
    assert bucketed.read_bucketed(spark, days[0] + "-none") is None
    bucketed.write_bucketed(bucketed.read_bucketed(spark, days[0]).limit(2), days[0], ["user_id"], 2)
    assert bucketed.read_bucketed(spark, days[0]).count() == 2


def test_jobs_give_the_same_from_buckets(spark, small, tmp_path):
    for name in ("tracker", "orders", "items"):
        getattr(tables, name)(spark, small).write.parquet(f"{tmp_path}/raw/{name}")
    found = []
    for buckets in (0, 3):
        split = jobs.SplitSettings(tables.TRAIN_END, tables.VALID_END, shards=2, buckets=buckets)
        jobs.split_job(spark, f"{tmp_path}/raw/tracker", f"{tmp_path}/raw/orders", f"{tmp_path}/s{buckets}", split)
        features = jobs.FeatureSettings(shards=2, sparse_attributes=bool(buckets))
        jobs.features_job(spark, f"{tmp_path}/s{buckets}", f"{tmp_path}/raw/items", f"{tmp_path}/f{buckets}", features)
        data = jobs.prepare(spark, f"{tmp_path}/s{buckets}", f"{tmp_path}/cache", jobs.TrainSettings())
        found.append([as_set(commits.read_part(spark, f"{tmp_path}/f{buckets}", f"inter_features/{s}")) for s in ("train", "valid")] + [as_set(data.ratings)])
    assert found[0] == found[1]
    things = commits.read_part(spark, f"{tmp_path}/f3", "items_features")
    assert things.count() == 200 and dict(things.dtypes)["value_ids"] == "array<bigint>"
    assert commits.read_part(spark, f"{tmp_path}/f0", "attribute_values") is None


def skewed(spark, n=6000):
    """Item 7 has a third of all rows, user 3 a quarter."""
    random_ = random.Random(2)
    rows = [(3 if random_.random() < 0.25 else random_.randrange(500), 7 if random_.random() < 1 / 3 else random_.randrange(900), k) for k in range(n)]
    rows += [(None, 7, -1), (5, None, -2)]
    return rows, spark.createDataFrame(rows, "user_id bigint, item_id bigint, k bigint").repartition(12)


@pytest.mark.parametrize("share", [0.5, 0.2, 0.02, 0.0015])
def test_hot_ids(spark, share):
    rows, frame = skewed(spark)
    counts = Counter(i for _, i, _ in rows if i is not None)
    total = sum(counts.values())
    exact = {r["id"]: r["n"] for r in hot.hot_ids(frame, "item_id", share, exact=True).collect()}
    assert exact == {i: n for i, n in counts.items() if n > share * total}
    found = {r["id"]: r["n"] for r in hot.hot_ids(frame, "item_id", share).collect()}
    assert set(exact) <= set(found) and len(found) <= 2 / share
    assert all(n <= counts[i] and counts[i] > share / 2 * total for i, n in found.items())


def test_summaries_bound_the_counts(spark):
    rows, frame = skewed(spark)
    counts = Counter(i for _, i, _ in rows if i is not None)
    for counters in (1, 5, 40, 5000):
        told = hot.summarise(frame, "item_id", counters).collect()
        assert all(r["at_least"] <= counts[r["id"]] <= r["at_most"] for r in told)
        assert all(r["at_most"] - r["at_least"] <= r["total"] / (counters + 1) for r in told)
    assert hot.hot_ids(frame.limit(0), "item_id", 0.1).count() == 0


def test_no_task_holds_a_hot_id_whole(spark, plain_joins):
    rows, frame = skewed(spark)
    users, things = idmaps.id_map("user_id", frame), idmaps.id_map("item_id", frame)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        plainly = idmaps.index_interactions(frame, users, things)
        mine = idmaps.index_interactions(frame, users, things, 0.02)
        assert as_set(mine, *plainly.columns) == as_set(plainly)
        hot_item = sum(i == 7 for _, i, _ in rows)
        parts = mine.where("item_id = 7").groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in parts.collect()) < 0.5 * hot_item
        whole = plainly.where("user_id = 3").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(whole) == 1
        features = spark.createDataFrame([(i, f"x{i}") for i in range(0, 900, 2)] + [(7, "seven")], "item_id bigint, label string")
        views = [sequences.training_view(frame, features, ["label"], hot_share=s) for s in (None, 0.02)]
        assert as_set(views[1], *views[0].columns) == as_set(views[0])
        parts = views[1].where("item_id = 7").groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in parts.collect()) < 0.5 * hot_item
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_join_apart_kinds(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "id bigint, v string")
    table = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "id bigint, w string")
    known = spark.createDataFrame([(1,), (9,)], "id bigint")
    assert as_set(hot.join_apart(rows, table, ["id"], known)) == as_set(rows.join(table, "id"))
    assert as_set(hot.join_apart(rows, table, ["id"], known, "left"), "id", "v", "w") == as_set(rows.join(table, "id", "left"), "id", "v", "w")
    with pytest.raises(ValueError):
        hot.join_apart(rows, table, ["id"], known, "full")


def test_sparse_values_say_what_flags_say(spark, small):
    things = tables.items(spark, small)
    attributes = items.item_attributes(things)
    flags = items.flag_features(attributes, items.frequent_values(items.attribute_frequency(attributes, 200, 0.01)))
    dictionary = items.attribute_dictionary(attributes)
    names = {r["value_id"]: (r["attr_name"], r["attr_value"]) for r in dictionary.collect()}
    assert sorted(names) == list(range(len(names))) and [names[k] for k in sorted(names)] == sorted(names.values())
    for parts in (1, 1000):
        sparse = {r["item_id"]: [names[v] for v in r["value_ids"]] for r in items.sparse_attributes(attributes, dictionary, parts).collect()}
        for row in flags.collect():
            mine = {f"{items.FLAG_ATTRIBUTES[n]}_{v}" for n, v in sparse[row["item_id"]] if n in items.FLAG_ATTRIBUTES}
            assert {c for c in flags.columns if row[c] is True} == {c for c in mine if c in flags.columns}
    mains = items.main_value_ids(attributes, dictionary, ("Type", "Brand"))
    values = items.frequent_values(attributes.groupBy("attr_name", "attr_value").count())
    assert as_set(mains, "item_id", "type_main", "brand_main") == as_set(items.main_values(attributes, values), "item_id", "type_main", "brand_main")


def test_empty_attributes(spark, small):
    things = tables.items(spark, small).limit(0)
    dictionary = items.attribute_dictionary(items.item_attributes(things))
    assert items.item_features_sparse(things, dictionary).count() == 0
    assert interactions.daily_actions_map(tables.tracker(spark, small).limit(0)).count() == 0
