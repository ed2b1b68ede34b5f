"""How actions relate to order outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expressions import any_signal, epoch_seconds
from shelfwise.functions.labels import CANCELED, DELIVERED
from shelfwise.functions.sqltext import quoted, ticked
from shelfwise.operators.interactions import PAIR, category_values, with_day_keys
from shelfwise.workspace import write_down

# Fixed value: keeps residuals and logarithms of empty cells finite.
EPSILON = 1e-12
# Prefixes that tell a category apart from a missing one while statuses are columns.
PRESENT, MISSING = "=", "-"


def pair_actions(tracker: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Events per (user, item), one column per action; 0 where there are none.

    Conditional counts take one shuffle, where a pivot takes two.
    """
    return tracker.groupBy(*PAIR).agg(
        *[F.expr(f"count_if(action_type = {quoted(a)})").alias(a) for a in actions]
    )


def value_counts(df: DataFrame, name: str, more_than: int = 0) -> DataFrame:
    """Rows per value, only those seen more than ``more_than`` times."""
    return df.groupBy(name).agg(F.count("*").alias("count")).where(F.col("count") > more_than)


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    """First and last instant, as they are and in epoch seconds."""
    seconds = epoch_seconds(df, ts)
    return df.agg(
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
        F.min(seconds).alias("first_epoch"),
        F.max(seconds).alias("last_epoch"),
    )


def last_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row per key by explicit order columns; nulls in the order come first.

    A maximum over structs combines on the map side, so no key is gathered or sorted.
    """
    rest = [c for c in df.columns if c not in (*keys, *order_by)]
    last = df.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def last_status(orders: DataFrame) -> DataFrame:
    """Status with the latest status time per (user, item); equal times go to the greater status."""
    latest = last_row(orders.select(*PAIR, "last_status", "last_status_timestamp"), PAIR, ["last_status_timestamp"])
    return latest.select(*PAIR, "last_status")


def pair_features(orders: DataFrame, tracker: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Last order status of a pair beside its action counts."""
    joined = last_status(orders).join(pair_actions(tracker, actions), list(PAIR), "left")
    counts = [f"coalesce({ticked(a)}, 0) AS {ticked(a)}" for a in actions]
    return joined.selectExpr(*PAIR, "last_status", *counts)


def _correlation(x: str, y: str) -> str:
    """Pearson correlation over rows where both are known; null where one of them is constant."""
    x_known, y_known = (f"CASE WHEN {v} IS NOT NULL THEN {w} END" for v, w in ((y, x), (x, y)))
    return f"try_divide(covar_pop({x}, {y}), stddev_pop({x_known}) * stddev_pop({y_known}))"


def label_correlation(features: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Pearson correlation of delivery with each action count, plain and as log1p.

    One pass over the pairs; a constant column has no correlation.
    """
    delivered = f"CAST(last_status = '{DELIVERED}' AS DOUBLE)"
    aggs, rows = [], []
    for i, action in enumerate(actions):
        count = f"CAST({ticked(action)} AS DOUBLE)"
        aggs.append(f"{_correlation(count, delivered)} AS raw_{i}")
        aggs.append(f"{_correlation(f'log1p({count})', delivered)} AS log_{i}")
        rows.append(f"named_struct('feature', {quoted(action)}, 'pearson', raw_{i}, 'pearson_log1p', log_{i})")
    table = features.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(rows)}))")
    sized = table.selectExpr("*", "abs(pearson) AS abs_pearson", "abs(pearson_log1p) AS abs_pearson_log1p")
    return sized.orderBy(F.desc_nulls_last("abs_pearson_log1p"), F.desc_nulls_last("abs_pearson"), "feature")


def _rates(features: DataFrame, signals: dict[str, str]) -> DataFrame:
    """Share of delivered and of cancelled pairs among those with a signal, one row per signal."""
    aggs, rows = [], []
    for i, (name, present) in enumerate(signals.items()):
        aggs.append(f"count_if({present}) AS n_{i}")
        for status, short in ((DELIVERED, "d"), (CANCELED, "c")):
            aggs.append(f"count_if({present} AND last_status = '{status}') AS {short}_{i}")
        rows.append(
            f"named_struct('signal', {quoted(name)}, 'n_pairs', n_{i}, "
            f"'delivered_rate', try_divide(d_{i}, n_{i}), 'canceled_rate', try_divide(c_{i}, n_{i}))"
        )
    return features.agg(*map(F.expr, aggs)).selectExpr(f"inline(array({', '.join(rows)}))")


def signal_rates(features: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Outcome rates of the pairs that saw each action."""
    return _rates(features, {a: f"{ticked(a)} > 0" for a in actions})


def any_signal_rate(features: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Outcome rates of the pairs that saw at least one of the actions."""
    return _rates(features.withColumn("_any", any_signal(*map(ticked, actions))), {"any": "_any"})


def contingency(tracker: DataFrame, orders: DataFrame) -> DataFrame:
    """``(action_type, last_status, observed)`` over the full grid of categories.

    Counts (event, matching order) rows of the day-wise left join, as products of daily
    counts, so the joined rows themselves are never made. A missing action or status is a
    category of its own and stays null; combinations that never occur count 0.
    """
    by_day = ["date", *PAIR]
    clicks = with_day_keys(tracker).groupBy(*by_day, "action_type").agg(F.count("*").alias("_events"))
    outcomes = (
        with_day_keys(orders, "last_status_timestamp")
        .where(F.col("date").isNotNull())
        .groupBy(*by_day, "last_status")
        .agg(F.count("*").alias("_orders"))
    )
    matched = clicks.join(outcomes, by_day, "left")
    named = matched.select(
        "action_type",
        F.coalesce(F.concat(F.lit(PRESENT), "last_status"), F.lit(MISSING)).alias("last_status"),
        (F.col("_events") * F.coalesce("_orders", F.lit(1))).alias("_rows"),
    )
    statuses = [*[PRESENT + s for s in category_values(orders, "last_status")], MISSING]
    wide = named.groupBy("action_type").pivot("last_status", statuses).agg(F.sum("_rows"))
    cells = [
        F.struct(
            F.lit(s[1:] if s != MISSING else None).cast("string").alias("last_status"),
            F.coalesce(F.col(ticked(s)), F.lit(0)).alias("observed"),
        )
        for s in statuses
    ]
    grid = write_down(wide.select("action_type", F.inline(F.array(*cells))), "grid").table
    # A status that no joined row has is no category of the table.
    seen = grid.groupBy(F.col("last_status").alias("_status")).agg(F.sum("observed").alias("_seen")).where(F.col("_seen") > 0)
    return grid.join(seen, F.col("last_status").eqNullSafe(F.col("_status")), "left_semi")


def cell_statistics(table: DataFrame) -> DataFrame:
    """Expected count, Pearson residual and PMI of every cell.

    Totals are aggregations joined back to the cells, so no task needs to hold the grid.
    """

    def totals(key: str, name: str) -> DataFrame:
        return table.groupBy(F.col(key).alias(f"_of{name}")).agg(F.sum("observed").alias(name))

    sized = (
        table.join(totals("action_type", "_row"), F.col("action_type").eqNullSafe(F.col("_of_row")))
        .join(totals("last_status", "_col"), F.col("last_status").eqNullSafe(F.col("_of_col")))
        .withColumn("_n", table.agg(F.sum("observed")).scalar())
    )
    n, observed = F.col("_n"), F.col("observed")
    expected = F.col("_row") * F.col("_col") / n
    chance = (F.col("_row") / n) * (F.col("_col") / n)
    return sized.select(
        "action_type",
        "last_status",
        "observed",
        expected.alias("expected"),
        ((observed - expected) / F.sqrt(expected + EPSILON)).alias("residual"),
        F.ln((observed / n + EPSILON) / (chance + EPSILON)).alias("pmi"),
    )


def cramers_v(table: DataFrame) -> DataFrame:
    """Chi-squared and Cramér's V of the whole table; an empty table is an error."""
    cells = cell_statistics(table)
    gap = F.col("observed") - F.col("expected")
    sums = cells.agg(
        F.sum("observed").alias("n"),
        F.sum(gap * gap / (F.col("expected") + EPSILON)).alias("chi2"),
        F.count_distinct(F.struct("action_type")).alias("_r"),
        F.count_distinct(F.struct("last_status")).alias("_c"),
    )
    filled = F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit("empty contingency table")).cast("long"))
    freedom = F.greatest(F.lit(1), F.least(F.col("_r") - 1, F.col("_c") - 1))
    return sums.withColumn("n", filled).select("n", "chi2", F.sqrt(F.col("chi2") / (F.col("n") * freedom)).alias("cramers_v"))
