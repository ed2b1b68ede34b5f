import json
import os

import pytest
from helpers import as_set

from shelfwise.catalog import tables
from shelfwise.plans import jobs
from shelfwise.sources.commits import folder_of, newest
from shelfwise.sources.sinks import SHARD


def version_of(spark, path):
    return folder_of(path, newest(spark, path).version)


def text_of(path, suffix):
    return "".join(open(f"{path}/{n}").read() for n in sorted(os.listdir(path)) if n.endswith(suffix))


@pytest.fixture(scope="module")
def run(spark, small, tmp_path_factory):
    """All stages over the smallest tables, exchanging files as separate processes would."""
    root = str(tmp_path_factory.mktemp("run"))
    tables.tracker(spark, small).write.parquet(f"{root}/raw/tracker")
    tables.orders(spark, small).write.parquet(f"{root}/raw/orders")
    tables.items(spark, small).write.parquet(f"{root}/raw/items")
    tables.tracker(spark, small).select("user_id").distinct().limit(9).write.parquet(f"{root}/raw/users/deep")
    spark.createDataFrame([(9999,)], "user_id bigint").write.parquet(f"{root}/raw/users/other")
    split = jobs.SplitSettings(tables.TRAIN_END, tables.VALID_END, shards=4)
    jobs.split_job(spark, f"{root}/raw/tracker", f"{root}/raw/orders", f"{root}/splits", split)
    jobs.features_job(spark, f"{root}/splits", f"{root}/raw/items", f"{root}/features", jobs.FeatureSettings(shards=4))
    train = jobs.TrainSettings(params={"factors": 4, "iterations": 3}, ks=(5, 20), top_n=20)
    jobs.train_job(spark, f"{root}/splits", f"{root}/artifacts", train)
    jobs.infer_job(spark, f"{root}/artifacts", f"{root}/raw/users", f"{root}/submission", 20)
    return root


def test_splits(spark, run):
    parts = [spark.read.parquet(f"{run}/splits/{s}/tracker").count() for s in ("train", "valid")]
    assert parts == [520, 480]
    assert {n for n in os.listdir(version_of(spark, f"{run}/splits/train/tracker")) if n.startswith(SHARD)} == {f"{SHARD}={i}" for i in range(4)}


def test_features(spark, run):
    tables_ = [spark.read.parquet(f"{run}/features/inter_features/{s}") for s in ("train", "valid")]
    assert tables_[0].columns == tables_[1].columns
    days = {s: spark.read.parquet(f"{run}/splits/{s}/tracker").selectExpr("to_date(timestamp)", "user_id", "item_id") for s in ("train", "valid")}
    for table, s in zip(tables_, ("train", "valid")):
        assert table.count() == days[s].distinct().count()
    assert spark.read.parquet(f"{run}/features/items_features").count() == 200
    assert spark.read.parquet(f"{run}/features/users_features").count() == 15


def test_metrics_and_model(spark, run):
    metrics = json.loads(text_of(f"{run}/artifacts/metrics", ".json"))
    assert set(metrics) == {"recall_at_5", "ndcg_at_5", "recall_at_20", "ndcg_at_20"}
    assert all(0 <= v <= 1 for v in metrics.values()) and metrics["recall_at_20"] > 0
    assert len(os.listdir(f"{run}/artifacts/cache")) == 5


def test_submission(run):
    lines = text_of(f"{run}/submission", ".csv").splitlines()
    rows = [line.split(",") for line in lines if line[0].isdigit()]
    assert len(rows) == 10
    assert all(len(set(items.split(" "))) == 20 for _, items in rows)
    assert "9999" in {u for u, _ in rows}


def test_sequence_tables(spark, run):
    jobs.sequence_job(spark, f"{run}/features", f"{run}/sequences", jobs.SequenceSettings(length=6))
    train, valid = (spark.read.parquet(f"{run}/sequences/{s}") for s in ("train", "valid"))
    assert train.columns == valid.columns
    assert train.count() == spark.read.parquet(f"{run}/features/inter_features/train").count()
    assert train.selectExpr("max(item_length)").first()[0] == 6
    assert dict(train.dtypes)["cnt_to_cart_sum_14d_past"] == "float"
    assert train.where("size(item_id_list) != item_length").isEmpty()


@pytest.mark.parametrize("kind", ["time_user_split", "only_train"])
def test_other_splits(spark, run, tmp_path, kind):
    settings = jobs.SplitSettings(tables.TRAIN_END, tables.VALID_END, kind, 0.5, 50, 17, fast_users=12, shards=2)
    jobs.split_job(spark, f"{run}/raw/tracker", f"{run}/raw/orders", str(tmp_path), settings)
    train = as_set(spark.read.parquet(f"{tmp_path}/train/tracker").select("user_id").distinct())
    if kind == "only_train":
        assert len(train) == 12 and not os.path.exists(f"{tmp_path}/valid")
    else:
        valid = as_set(spark.read.parquet(f"{tmp_path}/valid/tracker").select("user_id").distinct())
        assert train and valid and not train & valid


def test_no_test_users(spark, run, tmp_path):
    spark.createDataFrame([], "user_id bigint").write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        jobs.infer_job(spark, f"{run}/artifacts", str(tmp_path / "none"), str(tmp_path / "out"))


def test_command_line(spark, run, tmp_path):
    from shelfwise.__main__ import main

    main(
        ["split", "--tracker", f"{run}/raw/tracker", "--orders", f"{run}/raw/orders", "--out", str(tmp_path)]
        + ["--set", f"train_end={tables.TRAIN_END}", f"valid_end={tables.VALID_END}", "kind=time_split", "shards=2"]
    )
    assert spark.read.parquet(f"{tmp_path}/train/tracker").count() == 520
    with pytest.raises(SystemExit):
        main(["split", "--out", str(tmp_path)])
