import datetime as dt
import random

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from shelfwise.operators import sequences as ops
from shelfwise.operators.idmaps import id_map, index_interactions
from shelfwise.operators.numbering import number_rows


def log(spark, users=6, n=400, seed=3):
    """One user holds most rows."""
    rng = random.Random(seed)
    rows = {
        (dt.date(2024, 1, rng.randint(1, 20)), 0 if rng.random() < 0.6 else rng.randint(-2, users), rng.randint(100, 140))
        for _ in range(n)
    }
    return spark.createDataFrame(sorted(rows, key=lambda r: rng.random()), "date date, user_id bigint, item_id bigint")


def test_number_rows_within_groups(spark):
    df = log(spark)
    got = number_rows(df, ["date", "item_id"], within=["user_id"])
    assert got.columns == ["user_id", *[c for c in df.columns if c != "user_id"], "position"]
    groups = {}
    for r in sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0], r[2])):
        groups.setdefault(r[1], []).append(r)
    want = {(*row, i) for rows in groups.values() for i, row in enumerate(rows)}
    assert as_set(got, "date", "user_id", "item_id", "position") == want


def test_id_map_is_dense_and_sorted(spark):
    a = spark.createDataFrame([(30,), (-5,), (30,), (None,)], "user_id bigint")
    b = spark.createDataFrame([(7,), (-5,)], "user_id int")
    assert as_set(id_map("user_id", a, b)) == {(-5, 0), (7, 1), (30, 2)}


def test_indexing_drops_unmapped_and_keeps_external_ids(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (1, 11)], "user_id bigint, item_id bigint")
    users = spark.createDataFrame([(1, 0)], "ext_id bigint, idx bigint")
    items = spark.createDataFrame([(10, 4)], "ext_id bigint, idx bigint")
    assert as_set(index_interactions(df, users, items), "user_id", "item_id", "user_idx", "item_idx") == {(1, 10, 0, 4)}


def indexed(spark):
    df = log(spark)
    return index_interactions(df, id_map("user_id", df), id_map("item_id", df))


@pytest.mark.parametrize("block", [10_000, 40, 7, 1])
def test_history_is_the_same_in_blocks(spark, block):
    rows, length = indexed(spark), 7
    got = ops.user_history(rows, length, block=block)
    want, per_user = set(), {}
    ordered = rows.select("user_idx", "date", "item_idx").collect()
    for u, d, i in sorted(map(tuple, ordered)):
        past = per_user.setdefault(u, [])
        want.add((u, d, i, tuple(past[-length:]), len(past[-length:])))
        past.append(i)
    have = {
        (r["user_idx"], r["date"], r["item_idx"], tuple(r["item_id_list"]), r["item_length"]) for r in got.collect()
    }
    assert have == want and got.count() == rows.count()
    assert got.columns == [*rows.columns, "item_id_list", "item_length"]


def test_padding(spark):
    df = spark.createDataFrame([([],), ([0, 5],), ([1, 2, 3, 4],)], "s array<bigint>")
    assert [r[0] for r in df.select(ops.pad_left("s", 3)).collect()] == [[0, 0, 0], [0, 1, 6], [3, 4, 5]]


def test_batches_cover_shards_in_order(spark):
    df = log(spark)
    got = ops.with_batches(df, 3, 32)
    assert got.count() == df.count()
    groups = {}
    for r in got.collect():
        groups.setdefault(r["shard"], []).append((r["user_id"], r["date"], r["item_id"], r["batch"]))
    assert set(groups) == {0, 1, 2}
    for rows in groups.values():
        rows.sort()
        assert [r[3] for r in rows] == [i // 32 for i in range(len(rows))]


def test_training_views(spark):
    inter = spark.createDataFrame(
        [(1, 10, dt.date(2024, 1, 2), 1), (1, 99, dt.date(2024, 1, 1), 0), (2, 10, dt.date(2024, 1, 1), 1)],
        "user_id bigint, item_id bigint, date date, target int",
    )
    items = spark.createDataFrame([(10, "c", 1)], "item_id bigint, catalogid string, unused int")
    users = spark.createDataFrame([(2, 33)], "user_id bigint, age int")
    view = ops.training_view(inter, items, ["catalogid"], users, ["age"])
    assert as_set(view, "user_id", "item_id", "catalogid", "age") == {(1, 10, "c", None), (1, 99, None, None), (2, 10, "c", 33)}
    assert "unused" not in view.columns
    positive = ops.positive_view(view)
    assert [(r["user_id"], r["item_id"]) for r in positive.collect()] == [(1, 10), (2, 10)]
    assert ops.training_view(inter).columns == inter.columns


@pytest.mark.parametrize("block", [10_000, 5])
def test_sequence_view(spark, block):
    df = log(spark).withColumn("target", F.lit("1"))
    items = spark.createDataFrame([(i, str(i), [float(i), 1.0]) for i in range(100, 120)], "item_id bigint, cat string, vec array<float>")
    view = ops.sequence_training_view(
        df, id_map("user_id", df), id_map("item_id", df), {"cat": "token", "vec": "float_seq"},
        items, ["cat", "vec"], length=4, block=block,
    )
    assert view.count() == df.count()
    row = view.where("item_id = 130").first()
    assert row["cat"] == 0 and row["vec"] == [] and row["target"] == 1.0
    kinds = dict(view.dtypes)
    assert kinds["target"] == "float" and kinds["date"] == "int" and kinds["cat"] == "bigint"
    assert view.agg(F.max("item_length")).first()[0] == 4
