import datetime as dt

import pytest
from helpers import as_set, at
from pyspark.sql import functions as F

from shelfwise.functions import expressions as ex
from shelfwise.functions.labels import RATING_LABELS, TARGET_LABELS, rating_label, target_label


def test_epoch_seconds_by_type(spark):
    df = spark.createDataFrame(
        [(at(1, 1.9), at(1, 1.9).replace(tzinfo=dt.timezone.utc), 7), (at(-40000, 0.5), None, -3)],
        "ntz timestamp_ntz, tz timestamp, n int",
    )
    rows = df.select(*[ex.epoch_seconds(df, c).alias(c) for c in ("ntz", "tz", "n")]).collect()
    base = 1_704_067_200
    assert tuple(rows[0]) == (base + 1, base + 1, 7)
    assert rows[1]["ntz"] == base - 40001 * 86_400


def test_epoch_seconds_ignores_session_zone(spark):
    df = spark.createDataFrame([(at(1),)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(ex.epoch_seconds(df, "t")).first()[0] == 1_704_067_200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "bigint"])
def test_cutoffs_are_whole_seconds(spark, kind):
    end = 1_705_363_200
    moments = [-1.0, 0.0, 0.5, 1.0]
    if kind == "bigint":
        rows = [(int(end + m),) for m in (-1, 0, 1)]
    else:
        zone = None if kind == "timestamp_ntz" else dt.timezone.utc
        rows = [(dt.datetime(2024, 1, 16, tzinfo=zone) + dt.timedelta(seconds=m),) for m in moments]
    df = spark.createDataFrame(rows, f"t {kind}")
    early = df.where(ex.epoch_at_most(df, "t", end)).count()
    late = df.where(ex.epoch_after(df, "t", end)).count()
    assert (early, late) == (len(rows) - 1, 1)
    slow = df.where(ex.epoch_seconds(df, "t") <= end).count()
    assert slow == early


def test_cutoff_reaches_the_scan(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet")
    plan = df.where(ex.epoch_at_most(df, "ts", 1_705_363_200))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts" in plan


def test_user_bucket_is_never_negative(spark):
    df = spark.createDataFrame([(-30,), (0,), (790,)], "user_id bigint")
    assert as_set(df.select("user_id", ex.user_bucket("user_id", 800, 17))) == {(-30, 787), (0, 17), (790, 7)}


def test_zero_fill_touches_numbers_only(spark):
    df = spark.createDataFrame([(None, None)], "n int, s string")
    assert tuple(ex.zero_fill(df).first()) == (0, None)


def test_any_signal(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 4, 2), (1, 0, 0)], "a bigint, b bigint, c bigint")
    assert [r[0] for r in df.select(ex.any_signal("a", "b", "c")).collect()] == [False, True, True]


def test_safe_names(spark):
    df = spark.createDataFrame([("Dark-Blue / X",)], "s string")
    assert df.select(ex.safe_name_of("s")).first()[0] == ex.safe_name("Dark-Blue / X") == "dark_blue___x"


def test_coerce(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), ("12", [1.5, 2.5], [3, None], 4), ("x", [], [], 5)],
        "s string, f array<float>, t array<bigint>, n int",
    )

    def got(name, kind):
        return [r[0] for r in df.select(ex.coerce_value(df, name, kind)).collect()]

    assert got("s", "token") == [0, 12, 0]
    assert got("s", "float") == [0.0, 12.0, 0.0]
    assert got("f", "float") == [0.0, 1.5, 0.0]
    assert got("f", "float_seq") == [[], [1.5, 2.5], []]
    assert got("t", "token_seq") == [[], [3, 0], []]
    assert got("t", "token") == [0, 3, 0]
    assert got("n", "token_seq") == [[], [4], [5]]
    assert got("n", "float_seq") == [[], [4.0], [5.0]]
    with pytest.raises(ValueError):
        ex.coerce_value(df, "n", "text")


def test_lenient_casts(spark):
    df = spark.createDataFrame([("1.5", "2024-01-02"), ("no", "2024-13-02"), (None, None)], "y string, d string")
    rows = df.select(ex.lenient_label("y"), ex.lenient_day(df, "d")).collect()
    assert [tuple(r) for r in rows] == [(1.5, 19724), (None, None), (None, None)]


def test_labels(spark):
    rows = [
        ("to_cart", "delivered_orders"),
        ("to_cart", None),
        ("favorite", "canceled_orders"),
        ("view_description", None),
        ("page_view", "canceled_orders"),
        (None, "delivered_orders"),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "action_type string, last_status string")

    def got(label):
        return [r[0] for r in df.select(label.column()).collect()]

    assert got(rating_label("combined")) == [5.0, 3.0, 3.0, 1.0, 0.0, 5.0, 0.0]
    assert got(rating_label("combined2")) == [1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0]
    assert got(rating_label("delivered")) == [1.0, None, 0.0, None, 0.0, 1.0, None]
    assert got(rating_label("to_cart")) == [1.0, 1.0, 0.0, 0.0, 0.0, None, None]
    assert got(rating_label("to_cart_and_delivered")) == [1.0, None, 0.0, 0.0, 0.0, None, None]
    assert got(target_label("combined")) == [1, 1, 0, 0, 0, 1, 0]
    assert df.select(RATING_LABELS["combined"].column()).schema[0].dataType.simpleString() == "float"
    assert df.select(TARGET_LABELS["delivered"].column()).schema[0].dataType.simpleString() == "tinyint"


@pytest.mark.parametrize("select", [rating_label, target_label])
def test_unknown_label(select):
    with pytest.raises(ValueError):
        select("clicked")


def test_event_date(spark):
    df = spark.createDataFrame([(at(3, 86399.5),)], "t timestamp_ntz")
    assert df.select(ex.event_date("t")).first()[0] == dt.date(2024, 1, 3)
    assert df.select(ex.event_date(F.col("t"))).first()[0] == dt.date(2024, 1, 3)
