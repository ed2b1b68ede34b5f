"""Replacement of tables: what readers see while, and after, writers die."""

from __future__ import annotations

import os
import threading
import time

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from shelfwise.catalog import tables
from shelfwise.plans import jobs
from shelfwise.sources import commits, sinks


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "user_id bigint")


def versions(path):
    return sorted(n for n in os.listdir(path) if n.startswith("version="))


def failing(spark):
    """Some tasks write their rows, one fails."""
    rows = spark.range(0, 40, 1, 8)
    return rows.select(F.when(F.col("id") == 39, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("user_id"))


def test_manifest_lists_versions_and_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.newest(spark, path) is None and commits.read(spark, path) is None
    first = commits.replace(ids(spark, 1, 2, 3), path, note="a")
    staged = commits.stage(ids(spark, 7), path)
    assert as_set(commits.read(spark, path)) == {(1,), (2,), (3,)}
    second = commits.commit(spark, path, staged)
    listed = commits.entries(spark, path)
    assert [(e.number, e.rows, e.facts) for e in listed] == [(1, 3, {"note": "a"}), (2, 1, {})]
    assert as_set(commits.read(spark, path)) == {(7,)}
    assert as_set(commits.read(spark, path, first.version)) == {(1,), (2,), (3,)}
    commits.sweep(spark, path)
    assert versions(path) == [f"version={second.version}"]
    assert as_set(spark.read.parquet(path), "user_id") == {(7,)}


def test_a_job_that_dies_while_writing_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_sharded(ids(spark, 1, 2), path, shards=2)
    with pytest.raises(Exception, match="lost"):
        sinks.write_sharded(failing(spark), path, shards=2)
    assert as_set(sinks.read_sharded(spark, path)) == {(1,), (2,)}
    sinks.write_sharded(ids(spark, 5), path, shards=2)
    assert as_set(sinks.read_sharded(spark, path)) == {(5,)}


@pytest.mark.parametrize("step", ["_put", "_create"])
def test_a_job_that_dies_before_its_commit_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    commits.replace(ids(spark, 1, 2), path)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(commits, step, dies)
        with pytest.raises(KeyboardInterrupt):
            commits.replace(ids(spark, 9), path)
    assert as_set(commits.read(spark, path)) == {(1,), (2,)}
    # what it wrote stays while somebody could still be writing it, then goes
    commits.replace(ids(spark, 3), path)
    assert len(versions(path)) == 2
    monkeypatch.setattr(commits, "GRACE_SECONDS", -10)
    commits.replace(ids(spark, 4), path)
    assert len(versions(path)) == 1 and as_set(commits.read(spark, path)) == {(4,)}


def test_a_half_written_manifest_is_no_entry(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.replace(ids(spark, 1), path)
    open(f"{path}/_commits/_draft", "w").write("{")
    open(f"{path}/_commits/00000002.claim", "w").close()
    assert as_set(commits.read(spark, path)) == {(1,)}
    assert commits.replace(ids(spark, 2), path).number == 3


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = [commits.stage(ids(spark, n), path) for n in range(6)]
    threads = [threading.Thread(target=commits.commit, args=(spark, path, s)) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    listed = commits.entries(spark, path)
    assert sorted(e.version for e in listed) == sorted(s.version for s in staged)
    assert len({e.number for e in listed}) == 6


def test_two_builders_at_once_give_one_table(spark, tmp_path):
    calls, seen = [], []

    def build():
        calls.append(1)
        time.sleep(1)
        return ids(spark, len(calls))

    def ask():
        seen.append(as_set(sinks.keyed_table(spark, str(tmp_path), "t", {"a": 1}, build)))

    threads = [threading.Thread(target=ask) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(calls) == 1 and seen == [{(1,)}] * 4


def test_failed_and_dead_builders(spark, tmp_path):
    def breaks():
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.keyed_table(spark, str(tmp_path), "t", {}, breaks)
    assert sinks.keyed_table(spark, str(tmp_path), "t", {}, lambda: ids(spark, 1)).count() == 1
    # another one claimed the table and died
    path = f"{tmp_path}/{sinks.table_key({'table': 'u'})}/u"
    os.makedirs(f"{path}/_commits")
    open(f"{path}/_commits/00000001.claim", "w").close()
    assert sinks.keyed_table(spark, str(tmp_path), "u", {}, lambda: ids(spark, 1, 2), patience=0.5).count() == 2
    # two that build after all: the first commit counts
    late = commits.stage(ids(spark, 8), path)
    assert not commits._put(spark, path, 1, late)
    assert commits.read(spark, path).count() == 2


def test_a_changed_input_file_gives_a_new_table(spark, tmp_path):
    source = f"{tmp_path}/in"
    ids(spark, 1, 2).write.parquet(source)

    def built():
        return sinks.keyed_table(spark, f"{tmp_path}/cache", "t", {}, lambda: spark.read.parquet(source), [source])

    assert built().count() == 2
    before = commits.fingerprint(spark, source, f"{tmp_path}/none")
    assert before == commits.fingerprint(spark, source, f"{tmp_path}/none")
    ids(spark, 3).write.mode("append").parquet(source)
    assert before != commits.fingerprint(spark, source, f"{tmp_path}/none")
    assert built().count() == 3


@pytest.fixture()
def logs(spark, tmp_path, clicks, bought):
    clicks.write.parquet(f"{tmp_path}/raw/tracker")
    bought.write.parquet(f"{tmp_path}/raw/orders")
    return tmp_path


def test_a_split_counts_as_a_whole(spark, logs, clicks, monkeypatch):
    late = tables.VALID_END
    settings = jobs.SplitSettings(tables.TRAIN_END, late, shards=2)
    paths = (f"{logs}/raw/tracker", f"{logs}/raw/orders", f"{logs}/s")

    def rows():
        columns = ["user_id", "item_id"]
        return {(s, t): jobs._read_split(spark, f"{logs}/s", s, t, columns).count() for s in ("train", "valid") for t in ("tracker", "orders")}

    jobs.split_job(spark, *paths, settings)
    whole = rows()
    assert whole["train", "tracker"] == 10
    clicks.where("user_id = 1").write.parquet(f"{logs}/raw/less")

    def dies(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(commits, "commit_set", dies)
        with pytest.raises(KeyboardInterrupt):
            jobs.split_job(spark, f"{logs}/raw/less", *paths[1:], settings)
    assert rows() == whole
    jobs.split_job(spark, f"{logs}/raw/less", *paths[1:], settings)
    assert rows()["train", "tracker"] == 6
    assert len(versions(f"{logs}/s/train/tracker")) == 1


def test_features_refuse_an_unfinished_split(spark, logs, monkeypatch):
    settings = jobs.SplitSettings(tables.TRAIN_END, tables.VALID_END, shards=2)

    def dies(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(commits, "commit_set", dies)
        with pytest.raises(KeyboardInterrupt):
            jobs.split_job(spark, f"{logs}/raw/tracker", f"{logs}/raw/orders", f"{logs}/s", settings)
    with pytest.raises(FileNotFoundError):
        jobs.features_job(spark, f"{logs}/s", f"{logs}/raw/items", f"{logs}/f", jobs.FeatureSettings(shards=2))
    with pytest.raises(FileNotFoundError):
        jobs.prepare(spark, f"{logs}/s", f"{logs}/cache", jobs.TrainSettings())


def test_a_submission_that_fails_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "sub")
    rows = spark.createDataFrame([(1, 1, 20, 0.9)], "user_id bigint, rank int, item_id bigint, score double")
    sinks.write_submission(rows, path)
    before = spark.read.csv(path, header=True).collect()
    broken = rows.withColumn("item_id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_submission(broken, path)
    assert spark.read.csv(path, header=True).collect() == before
    sinks.write_submission(rows.withColumn("item_id", F.lit(7).cast("long")), path)
    assert [r[1] for r in spark.read.csv(path, header=True).collect()] == ["7"]
    assert os.listdir(tmp_path) == ["sub"]
