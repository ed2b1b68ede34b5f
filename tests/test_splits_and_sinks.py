import json
import os

import pytest
from helpers import as_set, at

from shelfwise.operators import splits
from shelfwise.sources import scans, sinks

END, LAST = 1_704_240_000, 1_704_412_800  # 2024-01-03 and 2024-01-05, midnight


def rows(df):
    return as_set(df, "user_id", "timestamp")


def log(spark):
    data = [(1, at(3)), (2, at(3, 0.5)), (3, at(3, 1)), (4, at(5, 0.9)), (5, at(5, 1)), (6, None)]
    return spark.createDataFrame(data, "user_id bigint, timestamp timestamp_ntz")


def test_time_split_edges(spark):
    train, valid = splits.time_split(log(spark), "timestamp", END, LAST)
    assert {u for u, _ in rows(train)} == {1, 2}
    assert {u for u, _ in rows(valid)} == {3, 4}


def test_time_user_split_has_disjoint_users(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet")
    split = splits.time_user_split(df, "ts", 1_705_363_200, 1_706_659_200, 0.5, 50, 17)
    train, valid = (as_set(p.select("user_id").distinct()) for p in split)
    assert train and valid and not train & valid
    everything = splits.time_split(df, "ts", 1_705_363_200, 1_706_659_200)
    assert split.valid.count() < everything.valid.count()


def test_split_by_name(spark):
    df = log(spark)
    assert splits.make_split(df, "timestamp", "only_train") == splits.Split(df, None)
    with pytest.raises(ValueError):
        splits.make_split(df, "timestamp", "random")


def test_user_slices(spark):
    df = spark.createDataFrame([(5,), (3,), (3,), (-1,), (9,)], "user_id bigint")
    few = splits.first_users(df, 2)
    assert as_set(few) == {(-1,), (3,)}
    assert splits.keep_users(df, few, 2).count() == 3
    assert as_set(splits.cap_users(df, 3)) == {(-1,), (3,), (5,)}
    assert splits.cap_users(df, None).count() == splits.cap_users(df, -1).count() == 4


def test_sharded_write_keeps_every_row_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(u, u * 2) for u in range(-20, 80)], "user_id bigint, v bigint")
    sinks.write_sharded(df, path, shards=7)
    back = spark.read.parquet(path)
    assert as_set(back, "user_id", "v") == as_set(df)
    assert back.where("pmod(user_id, 7) != _shard").isEmpty()
    per_shard = {r["shard"]: r["n_rows"] for r in sinks.shard_counts(df, shards=7).collect()}
    assert per_shard == {r[0]: r[1] for r in back.groupBy("_shard").count().collect()}
    sinks.write_sharded(df.limit(3), path, shards=7)
    assert spark.read.parquet(path).count() == 3


def test_scans(spark, tmp_path):
    root = str(tmp_path / "in")
    spark.createDataFrame([(1, 2, "x")], "user_id bigint, item_id bigint, extra string").coalesce(1).write.parquet(root + "/a")
    spark.createDataFrame([(1, 3), (4, 3)], "user_id bigint, item_id bigint").write.parquet(root + "/deep/b")
    both = scans.scan_selected(spark, [root + "/a", root + "/deep/b"], ["item_id"], schema="item_id bigint")
    assert sorted(r[0] for r in both.collect()) == [2, 3, 3]
    assert as_set(scans.distinct_users(spark, root)) == {(1,), (4,)}
    counts = scans.rows_per_file(spark, root + "/deep/b", "part-*.parquet")
    assert sum(r["n_rows"] for r in counts.collect()) == 2
    assert scans.first_files(spark, root + "/a", 1).count() == 1


def test_submission_file(spark, tmp_path):
    recs = spark.createDataFrame(
        [(1, 2, 30, 0.5), (1, 1, 20, 0.9), (2, 1, 5, 1.0)], "user_id bigint, rank int, item_id bigint, score double"
    )
    path = str(tmp_path / "s")
    sinks.write_submission(recs, path)
    lines = sorted(
        line
        for name in os.listdir(path)
        if name.endswith(".csv")
        for line in open(f"{path}/{name}").read().splitlines()
    )
    assert set(lines) == {"1,20 30", "2,5", "user_id,item_id_1 item_id_2 ... item_id_100"}


def test_metrics_file(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.write_metrics(spark.createDataFrame([("recall_at_5", 0.25), ("ndcg_at_5", 0.5)], "metric string, value double"), path)
    text = [open(f"{path}/{n}").read() for n in os.listdir(path) if n.endswith(".json")]
    assert json.loads("".join(text)) == {"recall_at_5": 0.25, "ndcg_at_5": 0.5}


def test_keyed_table_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for params in ({"a": 1, "b": 2}, {"b": 2, "a": 1}):
        assert sinks.keyed_table(spark, str(tmp_path), "t", params, build).count() == 3
    assert len(calls) == 1
    sinks.keyed_table(spark, str(tmp_path), "t", {"a": 2, "b": 2}, build)
    sinks.keyed_table(spark, str(tmp_path), "other", {"a": 1, "b": 2}, build)
    assert len(calls) == 3
    assert len(sinks.table_key({"a": 1})) == 16
