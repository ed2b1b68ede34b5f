"""Clicks and orders: daily counts, outcomes, labelled days, targets and features.

Counts are taken before anything is joined. One row per (user, item, day) is left on
each side, so the join of clicks with orders has no hot key however many events one
pair produced, and a window over a pair holds at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expressions import event_date
from shelfwise.functions.labels import DELIVERED, Label
from shelfwise.functions.sqltext import quoted, ticked

PAIR = ("user_id", "item_id")
DAY_KEYS = ("date", "user_id", "item_id")


def with_day_keys(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Ids as 64-bit integers and the event's calendar day in front of all other columns."""
    own = [ticked(c) for c in events.columns if c not in DAY_KEYS]
    ids = [f"CAST({c} AS BIGINT) AS {c}" for c in PAIR]
    return events.selectExpr(f"to_date({ts}) AS date", *ids, *own)


def category_values(df: DataFrame, name: str, limit: int | None = None) -> list:
    """Sorted distinct non-null values of a category column.

    They become columns, so they come to the driver. With a ``limit`` more than so many are
    an error.
    """
    values = df.select(name).where(F.col(name).isNotNull()).distinct()
    rows = (values if limit is None else values.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"{name} has more than {limit} distinct values; it is not a category")
    return sorted(r[0] for r in rows)


def basis(tracker: DataFrame) -> DataFrame:
    """Distinct (date, user, item)."""
    return with_day_keys(tracker).select(*DAY_KEYS).distinct()


def daily_actions(tracker: DataFrame) -> DataFrame:
    """Events per (date, user, item, action) in long form."""
    return with_day_keys(tracker).groupBy(*DAY_KEYS, "action_type").agg(F.count("*").alias("cnt"))


def _counts(actions: Sequence[str], prefix: str) -> list[Column]:
    return [F.expr(f"count_if(action_type = {quoted(a)})").alias(f"{prefix}{a}") for a in actions]


def daily_actions_map(tracker: DataFrame) -> DataFrame:
    """Events per (date, user, item) as one map from action to count, ``counts``, however many actions there are.

    Events are counted by action before they meet; what meets is one entry for each action
    of a day. Events without an action are left out, and days that have no others keep an empty map.
    """
    counted = daily_actions(tracker)
    known = F.when(F.col("action_type").isNotNull(), F.struct("action_type", "cnt"))
    return counted.groupBy(*DAY_KEYS).agg(F.map_from_entries(F.array_sort(F.collect_list(known))).alias("counts"))


def daily_actions_wide(tracker: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Events per (date, user, item), one ``cnt_<action>`` column per action."""
    return with_day_keys(tracker).groupBy(*DAY_KEYS).agg(*_counts(actions, "cnt_"))


def join_tracker_orders(tracker: DataFrame, orders: DataFrame) -> DataFrame:
    """Every event beside the orders of its user and item whose last status fell on its day.

    One output row per matching order; events without one keep a null status. This is the
    row-level form, left to adaptive skew splitting; aggregating callers use
    :func:`labelled_days`, which joins counts.
    """
    clicks = tracker.withColumn("date", event_date("timestamp"))
    outcomes = orders.select(*PAIR, "last_status", event_date("last_status_timestamp").alias("date"))
    return clicks.join(outcomes.where(F.col("date").isNotNull()), [*PAIR, "date"], "left")


def by_day(tracker: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks and orders with the day on which they meet, ready to be stored by :data:`DAY_KEYS`."""
    outcomes = with_day_keys(orders, "last_status_timestamp").where("date IS NOT NULL")
    return with_day_keys(tracker), outcomes


def join_days(clicks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """:func:`join_tracker_orders` for tables of :func:`by_day`.

    Both are dealt by the keys they are joined on if they are stored so; then nothing is shuffled.
    """
    return clicks.join(outcomes.select(*DAY_KEYS, "last_status"), list(DAY_KEYS), "left")


def as_logs(clicks: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of :func:`by_day` as the logs that all operators here take, their days in place of times.

    Days, counts and labels are the same, and aggregations and joins by day keep the way the
    tables are dealt.
    """
    days = clicks.drop("timestamp").withColumnRenamed("date", "timestamp")
    return days, outcomes.drop("last_status_timestamp").withColumnRenamed("date", "last_status_timestamp")


def daily_outcomes(orders: DataFrame) -> DataFrame:
    """Orders and delivered orders per (date, user, item) of their last status."""
    return (
        with_day_keys(orders, "last_status_timestamp")
        .where("date IS NOT NULL")
        .groupBy(*DAY_KEYS)
        .agg(
            F.expr("count(*) AS n_orders"),
            F.expr(f"count_if(last_status = '{DELIVERED}') AS n_delivered"),
        )
    )


def _signal_counts(label: Label) -> list[Column]:
    return [*_counts(label.actions, "_n_"), F.expr("count(*) AS _n_events")]


def _label_sum(label: Label) -> str:
    """Sum of a label over all (event, order) rows of a day, from the day's counts, as SQL.

    Labels look at the named actions and at "delivered or not", so a day's rows fall into
    few groups of equal label. An event without an order stands for one row of null status.
    """
    named = [(quoted(a), ticked(f"_n_{a}")) for a in label.actions]
    unnamed = " - ".join(["_n_events", *[count for _, count in named]])
    statuses = {
        f"'{DELIVERED}'": "coalesce(n_delivered, 0)",
        "CAST(NULL AS STRING)": "coalesce(n_orders - n_delivered, 1)",
    }
    terms = [
        f"({events}) * {rows} * CAST(coalesce({label.sql(action, status)}, 0) AS DOUBLE)"
        for action, events in [*named, ("CAST(NULL AS STRING)", unnamed)]
        for status, rows in statuses.items()
    ]
    return " + ".join(terms)


def labelled_days(tracker: DataFrame, orders: DataFrame | None, label: Label) -> DataFrame:
    """``label_sum`` per (date, user, item): the label summed over the joined events.

    Without orders every status is null.
    """
    days = with_day_keys(tracker).groupBy(*DAY_KEYS).agg(*_signal_counts(label))
    return _with_outcomes(days, orders).selectExpr(*DAY_KEYS, f"{_label_sum(label)} AS label_sum")


def _with_outcomes(days: DataFrame, orders: DataFrame | None) -> DataFrame:
    if orders is None:
        return days.selectExpr("*", "CAST(NULL AS BIGINT) AS n_orders", "CAST(NULL AS BIGINT) AS n_delivered")
    return days.join(daily_outcomes(orders), list(DAY_KEYS), "left")


def first_positive(tracker: DataFrame, orders: DataFrame | None, label: Label) -> DataFrame:
    """First day with a positive label per (user, item)."""
    positive = labelled_days(tracker, orders, label).where(F.col("label_sum") > 0)
    return positive.groupBy(*PAIR).agg(F.min("date").alias("first_pos_date"))


def _reached(horizon_days: int) -> str:
    within = f" AND first_pos_date <= date_add(date, {int(horizon_days)})" if horizon_days > 0 else ""
    return f"CASE WHEN first_pos_date >= date{within} THEN 1 ELSE 0 END"


def horizon_target(basis_days: DataFrame, first: DataFrame, horizon_days: int = 0) -> DataFrame:
    """1 where the pair's first positive day is the row's day or later, within the horizon.

    A horizon of 0 is unlimited.
    """
    joined = basis_days.join(first, list(PAIR), "left")
    return joined.selectExpr(*DAY_KEYS, f"{_reached(horizon_days)} AS target")


def dedup_target(target: DataFrame) -> DataFrame:
    """Every row of a pair carries the pair's greatest target."""
    pair = Window.partitionBy(*PAIR)
    return target.withColumn("target", F.max("target").over(pair))


def window_days(window: str) -> int:
    """``"14d"`` -> 14."""
    text = window.strip().lower()
    if not text.endswith("d") or not text[:-1].isdigit() or int(text[:-1]) < 1:
        raise ValueError(f"a window is a number of days such as '7d', not {window!r}")
    return int(text[:-1])


def rolled(action: str, window: str) -> str:
    return f"cnt_{action}_sum_{window.strip().lower()}_past"


# Rows of a pair in the order of days; every window over it shares one sort.
_BY_DAY = "PARTITION BY user_id, item_id ORDER BY unix_date(date)"


def _rolling_sums(actions: Sequence[str], windows: Sequence[str], direction: str) -> list[str]:
    if direction not in ("past", "forward"):
        raise ValueError(f"direction is 'past' or 'forward', not {direction!r}")
    sums = []
    for window in windows:
        days = window_days(window)
        past = f"{days} PRECEDING AND 1 PRECEDING"
        forward = f"CURRENT ROW AND {days - 1} FOLLOWING"
        frame = f"({_BY_DAY} RANGE BETWEEN {past if direction == 'past' else forward})"
        for action in actions:
            daily, total = ticked(f"cnt_{action}"), ticked(rolled(action, window))
            sums.append(f"coalesce(sum({daily}) OVER {frame}, 0) AS {total}")
    return sums


def rolling_actions(
    daily: DataFrame, actions: Sequence[str], windows: Sequence[str], direction: str = "past"
) -> DataFrame:
    """Rolling sums of daily counts per pair, one column per action and window.

    ``past`` sums the days ``[date - w, date)``; ``forward`` sums ``[date, date + w)``.
    All frames share one sort of the daily rows.
    """
    return daily.selectExpr(*DAY_KEYS, *_rolling_sums(actions, windows, direction))


def stack_windows(wide: DataFrame, actions: Sequence[str], windows: Sequence[str]) -> DataFrame:
    """One row per key and window; the other windows' columns are 0.

    The wide rows are unfolded in place, so the rolling sums are computed once.
    """
    names = [rolled(a, w) for w in windows for a in actions]
    kept = [ticked(c) for c in wide.columns if c not in names]

    def row(window: str) -> str:
        own = {rolled(a, window) for a in actions}
        fields = [f"{quoted(n)}, {ticked(n) if n in own else '0L'}" for n in names]
        return f"named_struct('window', {quoted(window)}, {', '.join(fields)})"

    return wide.selectExpr(*kept, f"inline(array({', '.join(row(w) for w in windows)}))")


def concat_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; absent ones are null."""
    return reduce(lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True), frames)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of frames with the same columns."""
    return reduce(lambda top, bottom: top.unionByName(bottom), frames)


def interaction_features(
    tracker: DataFrame,
    orders: DataFrame | None,
    label: Label,
    actions: Sequence[str] | None = None,
    windows: Sequence[str] = ("14d", "7d", "1d"),
    horizon_days: int = 0,
    drop_duplicate_targets: bool = True,
    direction: str = "past",
    layout: str = "wide",
) -> DataFrame:
    """Basis rows with target and rolling action counts.

    Clicks are aggregated to days once, joined to daily outcomes on the keys they are
    already partitioned by, and shuffled once more by pair, where target and all rolling
    sums are windows over at most one row per day.
    """
    if layout not in ("wide", "stacked"):
        raise ValueError(f"layout is 'wide' or 'stacked', not {layout!r}")
    actions = list(actions) if actions is not None else category_values(tracker, "action_type")
    counts = _counts(actions, "cnt_")
    # Rows without a day or an id are no basis rows: nothing could be joined to them.
    known = " AND ".join(f"{key} IS NOT NULL" for key in DAY_KEYS)
    days = with_day_keys(tracker).where(known).groupBy(*DAY_KEYS).agg(*counts, *_signal_counts(label))
    sums = _rolling_sums(actions, windows, direction)
    whole = f"({_BY_DAY} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    rows = _with_outcomes(days, orders).selectExpr(
        *DAY_KEYS,
        f"min(CASE WHEN {_label_sum(label)} > 0 THEN date END) OVER {whole} AS first_pos_date",
        *sums,
    )
    names = [ticked(rolled(a, w)) for w in windows for a in actions]
    wide = rows.selectExpr(*DAY_KEYS, f"{_reached(horizon_days)} AS target", *names)
    if drop_duplicate_targets:
        wide = dedup_target(wide)
    return wide if layout == "wide" else stack_windows(wide, actions, windows)
