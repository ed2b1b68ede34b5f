import datetime as dt

import pytest
from helpers import ORDERS, as_set
from pyspark.sql import functions as F

from shelfwise.functions.labels import RATING_LABELS, target_label
from shelfwise.operators import interactions as ops
from shelfwise.operators.ratings import binarise, build_ratings, popularity_by_weight, top_items

ACTIONS = ["favorite", "page_view", "remove", "to_cart"]


def test_basis_and_daily_counts(clicks):
    assert ops.basis(clicks).count() == 8
    daily = as_set(ops.daily_actions(clicks).where("user_id = 1 AND item_id = 10"), "action_type", "cnt")
    assert daily == {("page_view", 2), ("to_cart", 1), ("favorite", 1), ("view_description", 1)}
    wide = ops.daily_actions_wide(clicks, ACTIONS)
    # A day with only a missing action stays, with zeros.
    row = wide.where("user_id = 2 AND item_id = 10").first()
    assert [row[f"cnt_{a}"] for a in ACTIONS] == [0, 0, 0, 0]


def test_category_values(clicks):
    found = ops.category_values(clicks, "action_type")
    assert found == sorted(found) and None not in found and len(found) == 7
    with pytest.raises(ValueError):
        ops.category_values(clicks, "action_type", limit=3)


def test_join_fans_out_and_keeps_unmatched(clicks, bought):
    joined = ops.join_tracker_orders(clicks, bought)
    # Three clicks of one day times two orders, the other seven as they are.
    assert joined.count() == 13
    assert joined.where("last_status IS NOT NULL").count() == 8


@pytest.mark.parametrize("name", sorted(RATING_LABELS))
@pytest.mark.parametrize("with_orders", [True, False])
def test_labelled_days_equal_row_by_row(spark, clicks, bought, name, with_orders):
    label = RATING_LABELS[name]
    orders = bought if with_orders else spark.createDataFrame([], ORDERS)
    rows = ops.join_tracker_orders(clicks, orders).withColumn("y", label.column())
    want = rows.groupBy("date", "user_id", "item_id").agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("label_sum"))
    got = ops.labelled_days(clicks, bought if with_orders else None, label)
    columns = ["date", "user_id", "item_id", "label_sum"]
    assert as_set(got, *columns) == as_set(want, *columns)


def test_ratings_add_up(clicks, bought):
    rated = build_ratings(clicks, bought, RATING_LABELS["combined"])
    # Day one: three clicks beside a delivered order, then beside a cancelled one.
    assert as_set(rated) == {(1, 10, 15.0 + 3.0 + 3.0 + 1.0), (1, 11, 1.0), (2, 10, 5.0), (-3, 12, 5.0)}
    assert as_set(binarise(rated).select("rating").distinct()) == {(1.0,)}
    assert as_set(top_items(popularity_by_weight(rated), 2), "rank", "item_id") == {(1, 10), (2, 12)}


def test_horizon_and_dedup(spark, clicks, bought):
    days = ops.basis(clicks)
    first = ops.first_positive(clicks, bought, target_label("combined"))
    assert as_set(first) == {
        (1, 10, dt.date(2024, 1, 1)),
        (2, 10, dt.date(2024, 1, 2)),
        (-3, 12, dt.date(2024, 1, 6)),
    }
    unlimited = ops.horizon_target(days, first)
    positive = {r[:3] for r in as_set(unlimited) if r[3]}
    assert positive == {
        (dt.date(2024, 1, 1), 1, 10),
        (dt.date(2024, 1, 2), 2, 10),
        (dt.date(2024, 1, 5), -3, 12),
        (dt.date(2024, 1, 6), -3, 12),
    }
    spread = {r[:3] for r in as_set(ops.dedup_target(unlimited)) if r[3]}
    assert spread == positive | {(dt.date(2024, 1, 3), 1, 10), (dt.date(2024, 1, 9), 1, 10)}
    far = spark.createDataFrame([(1, 10, dt.date(2024, 1, 5))], "user_id bigint, item_id bigint, first_pos_date date")
    for horizon, want in ((0, {1, 3}), (2, {3}), (4, {1, 3})):
        hit = ops.horizon_target(days, far, horizon).where("target = 1")
        assert {r["date"].day for r in hit.collect()} == want


def test_rolling_directions(clicks):
    daily = ops.daily_actions_wide(clicks, ACTIONS).where("user_id = 1 AND item_id = 10")
    past = {r["date"].day: r for r in ops.rolling_actions(daily, ACTIONS, ["7d", "1d"]).collect()}
    assert past[1]["cnt_page_view_sum_7d_past"] == 0
    assert past[3]["cnt_page_view_sum_7d_past"] == 2 and past[3]["cnt_page_view_sum_1d_past"] == 0
    assert past[9]["cnt_page_view_sum_7d_past"] == 0 and past[9]["cnt_favorite_sum_7d_past"] == 1
    forward = {r["date"].day: r for r in ops.rolling_actions(daily, ACTIONS, ["7d", "1d"], "forward").collect()}
    assert forward[1]["cnt_favorite_sum_7d_past"] == 1 and forward[1]["cnt_favorite_sum_1d_past"] == 0
    assert forward[3]["cnt_favorite_sum_1d_past"] == 1
    with pytest.raises(ValueError):
        ops.rolling_actions(daily, ACTIONS, ["7d"], "backwards")
    for window in ("7", "0d", "week"):
        with pytest.raises(ValueError):
            ops.window_days(window)


@pytest.mark.parametrize("direction", ["past", "forward"])
@pytest.mark.parametrize("dedup", [True, False])
def test_feature_table_equals_its_parts(clicks, bought, direction, dedup):
    """The one-pass plan against basis, target and rolling sums joined as separate tables."""
    label, windows = target_label("delivered"), ["7d", "2d"]
    keys = list(ops.DAY_KEYS)
    days = ops.basis(clicks)
    target = ops.horizon_target(days, ops.first_positive(clicks, bought, label), 3)
    if dedup:
        best = target.groupBy(*ops.PAIR).agg(F.max("target").alias("target"))
        target = days.join(best, list(ops.PAIR), "inner")
    rolled = ops.rolling_actions(ops.daily_actions_wide(clicks, ACTIONS), ACTIONS, windows, direction)
    want = days.join(target, keys, "inner").join(rolled, keys, "left").na.fill(0)
    got = ops.interaction_features(
        clicks, bought, label, ACTIONS, windows, 3, drop_duplicate_targets=dedup, direction=direction
    )
    assert as_set(got, *want.columns) == as_set(want)


def test_stacked_layout_is_the_relaxed_union(clicks, bought):
    windows = ["7d", "2d"]
    wide = ops.interaction_features(clicks, bought, target_label("delivered"), ACTIONS, windows, direction="forward")
    parts = [
        wide.select(*ops.DAY_KEYS, "target", F.lit(w).alias("window"), *[ops.rolled(a, w) for a in ACTIONS])
        for w in windows
    ]
    want = ops.concat_relaxed(parts).na.fill(0)
    got = ops.interaction_features(
        clicks, bought, target_label("delivered"), ACTIONS, windows, direction="forward", layout="stacked"
    )
    assert got.count() == 2 * wide.count()
    assert as_set(got, *want.columns) == as_set(want)
    with pytest.raises(ValueError):
        ops.interaction_features(clicks, bought, target_label("delivered"), layout="tall")


def test_no_orders_means_no_delivery(clicks):
    features = ops.interaction_features(clicks, None, target_label("delivered"))
    assert features.where("target > 0").isEmpty()
    assert "cnt_review_view_sum_14d_past" in features.columns


def test_feature_plan_shuffles_clicks_twice(spark, clicks, bought):
    plan = ops.interaction_features(clicks, bought, target_label("delivered"), ACTIONS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # Clicks by day, clicks by pair, orders by day; one sort feeds all windows.
    assert text.count("Exchange hashpartitioning") == 3


def test_rows_without_day_or_id_are_no_basis_rows(spark, clicks, bought):
    partial = spark.createDataFrame(
        [(1, 10, None, "to_cart", "w"), (None, 10, dt.datetime(2024, 1, 1), "to_cart", "w")], clicks.schema
    )
    label = target_label("delivered")
    want = ops.interaction_features(clicks, bought, label)
    assert as_set(ops.interaction_features(clicks.unionByName(partial), bought, label)) == as_set(want)


def test_odd_category_names(spark, clicks, bought):
    """Values come from the data and may hold any character."""
    odd = clicks.withColumn("action_type", F.concat(F.lit("it's a-b \\n"), F.col("action_type")))
    actions = ops.category_values(odd, "action_type")
    plain = ops.interaction_features(clicks, bought, target_label("delivered"), layout="stacked")
    got = ops.interaction_features(odd, bought, target_label("delivered"), actions, layout="stacked")
    assert [len(r) for r in got.collect()] == [len(r) for r in plain.collect()]
    assert sorted(map(tuple, got.select(*ops.DAY_KEYS, *got.columns[5:]).collect())) == sorted(
        map(tuple, plain.select(*ops.DAY_KEYS, *plain.columns[5:]).collect())
    )
