"""Cases of the first review: results that small inputs once got wrong."""

from __future__ import annotations

import pytest
from helpers import as_set, at
from pyspark.sql import functions as F

from shelfwise.catalog import tables
from shelfwise.functions.labels import Label
from shelfwise.models.bpr import train_vectors
from shelfwise.operators import ratings, sequences
from shelfwise.operators.idmaps import id_map
from shelfwise.operators.numbering import number_rows
from shelfwise.plans import jobs
from shelfwise.sources import commits, scans, sinks


def test_null_groups_are_numbered(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (5, 1)], "user_id bigint, day int")
    assert as_set(number_rows(rows, ["day"], within=["user_id"])) == {(None, 1, 0), (None, 2, 1), (5, 1, 0)}


def test_float_sequences_keep_their_values(spark):
    df = spark.createDataFrame([([0.25, 0.75],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(sequences.pad_left("v", 3, kind="float")).collect()] == [[0.0, 0.25, 0.75], [0.0] * 3]


def test_labels_carry_their_actions(spark, clicks):
    label = Label("({action} = 'remove')")
    assert label.actions == ("remove",)
    assert as_set(ratings.build_ratings(clicks, None, label)) == {(2, 12, 1.0)}


def test_listing_tells_shards_apart(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("user_id"))
    sinks.write_sharded(rows, str(tmp_path / "t"), shards=4)
    folder = commits.folder_of(str(tmp_path / "t"), commits.newest(spark, str(tmp_path / "t")).version)
    listed = scans.rows_per_file(spark, folder).collect()
    assert len(listed) >= 4 and sum(r["n_rows"] for r in listed) == 40
    assert all(r["file_name"].startswith("_shard=") for r in listed)
    plan = scans.first_files(spark, str(tmp_path / "t"), 1)
    assert len(plan.inputFiles()) == 1


def test_empty_tables_can_be_read(spark, tmp_path):
    sinks.write_sharded(spark.range(3).where("id > 9").withColumnRenamed("id", "user_id"), str(tmp_path / "t"))
    back = sinks.read_sharded(spark, str(tmp_path / "t"))
    assert back.columns == ["user_id"] and back.isEmpty()
    assert sinks.read_sharded(spark, str(tmp_path / "none")) is None


@pytest.fixture()
def logs(spark, tmp_path, clicks, bought):
    clicks.write.parquet(f"{tmp_path}/raw/tracker")
    bought.write.parquet(f"{tmp_path}/raw/orders")
    return tmp_path


def test_only_train_and_splitting_again(spark, logs, clicks):
    settings = jobs.SplitSettings(tables.TRAIN_END, tables.VALID_END, "only_train", shards=2)
    jobs.split_job(spark, f"{logs}/raw/tracker", f"{logs}/raw/orders", f"{logs}/s", settings)
    train = jobs.TrainSettings(label="combined")
    first = jobs.prepare(spark, f"{logs}/s", f"{logs}/cache", train)
    assert first.truth.isEmpty() and first.user_map.count() == 3
    clicks.where("user_id = 1").write.parquet(f"{logs}/raw/less")
    jobs.split_job(spark, f"{logs}/raw/less", f"{logs}/raw/orders", f"{logs}/s", settings)
    assert jobs.prepare(spark, f"{logs}/s", f"{logs}/cache", train).user_map.count() == 1


def test_empty_validation_part(spark, logs):
    late = int(at(28).timestamp()) + 10**6
    settings = jobs.SplitSettings(late, late + 1, shards=2)
    jobs.split_job(spark, f"{logs}/raw/tracker", f"{logs}/raw/orders", f"{logs}/s", settings)
    items = spark.createDataFrame(
        [(10, 1, 2, 3, "x", [0.5], [])],
        "item_id bigint, catalogid int, variant_id int, model_id int, itemname string, fclip_embed array<float>, attributes array<struct<"
        "attribute_name:string,attribute_value:string,attribute_isaspect:boolean,attribute_showascharacteristic:boolean>>",
    )
    items.write.parquet(f"{logs}/raw/items")
    jobs.features_job(spark, f"{logs}/s", f"{logs}/raw/items", f"{logs}/f", jobs.FeatureSettings(shards=2))
    assert sinks.read_sharded(spark, f"{logs}/f/inter_features/valid").isEmpty()
    counted = jobs.TrainSettings(truth="features", popularity="count")
    data = jobs.prepare(spark, f"{logs}/s", f"{logs}/cache", counted, f"{logs}/f")
    assert data.truth.isEmpty() and not data.popularity.isEmpty()


def test_bpr_does_not_depend_on_partitions(spark):
    pairs = spark.createDataFrame([(u, i) for u in range(12) for i in range(u % 3, 9, 3)], "user_idx bigint, item_idx bigint")
    users = id_map("u", pairs.select(F.col("user_idx").alias("u")))
    items = id_map("i", pairs.select(F.col("item_idx").alias("i")))
    made = []
    for parts in (1, 7):
        vectors = train_vectors(pairs.repartition(parts), users, items, 4, 0.1, 0.01, 2)
        made.append({(r["side"], r["idx"]): r["vector"] for r in vectors.table.collect()})
    assert made[0].keys() == made[1].keys()
    assert all(abs(a - b) < 1e-4 for key, v in made[0].items() for a, b in zip(v, made[1][key], strict=True))
