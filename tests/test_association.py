import numpy as np
import pytest
from helpers import ORDERS, as_set, at
from pyspark.sql import functions as F

from shelfwise.operators import association as ops
from shelfwise.operators.interactions import join_tracker_orders
from shelfwise.plans.explore import association_report

ACTIONS = ["favorite", "page_view", "to_cart", "unfavorite"]


def test_last_row_puts_nulls_first(spark):
    rows = [(1, 1, None, "a"), (1, 1, at(1), "b"), (1, 2, None, "c"), (1, 3, at(2), "d"), (1, 3, at(2), "e")]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, last_status_timestamp timestamp_ntz, last_status string")
    assert as_set(ops.last_status(df)) == {(1, 1, "b"), (1, 2, "c"), (1, 3, "e")}
    assert ops.last_row(df, ["user_id"], ["last_status_timestamp"]).columns == df.columns


def test_pair_tables(clicks, bought):
    pairs = ops.pair_features(bought, clicks, ACTIONS)
    rows = {(r["user_id"], r["item_id"]): r for r in pairs.collect()}
    assert set(rows) == {(1, 10), (1, 11), (2, 10), (2, 12), (-3, 12), (7, 99)}
    assert rows[1, 10]["page_view"] == 2 and rows[1, 10]["last_status"] == "canceled_orders"
    assert [rows[7, 99][a] for a in ACTIONS] == [0, 0, 0, 0]
    assert rows[1, 11]["last_status"] is None


def test_rates(clicks, bought):
    pairs = ops.pair_features(bought, clicks, ACTIONS)
    rates = {r["signal"]: r for r in ops.signal_rates(pairs, ACTIONS).collect()}
    assert rates["to_cart"]["n_pairs"] == 2
    assert rates["to_cart"]["delivered_rate"] == rates["to_cart"]["canceled_rate"] == 0.5
    either = ops.any_signal_rate(pairs, ["favorite", "unfavorite"]).first()
    assert (either["n_pairs"], either["delivered_rate"]) == (2, 0.5)
    none = ops.signal_rates(pairs.where("false"), ["to_cart"]).first()
    assert none["n_pairs"] == 0 and none["delivered_rate"] is None


def test_correlations(spark):
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 6, (60, 2))
    y = rng.random(60) < 0.2 + counts[:, 0] / 10
    rows = [("delivered_orders" if d else "canceled_orders", int(a), int(b), 4) for d, (a, b) in zip(y, counts)]
    df = spark.createDataFrame(rows, "last_status string, a bigint, b bigint, same bigint")
    table = ops.label_correlation(df, ["a", "b", "same"]).collect()
    got = {r["feature"]: r for r in table}
    for i, name in enumerate("ab"):
        assert got[name]["pearson"] == pytest.approx(np.corrcoef(y, counts[:, i])[0, 1])
        assert got[name]["pearson_log1p"] == pytest.approx(np.corrcoef(y, np.log1p(counts[:, i]))[0, 1])
        assert got[name]["abs_pearson"] == abs(got[name]["pearson"])
    assert got["same"]["pearson"] is None and got["same"]["abs_pearson_log1p"] is None
    order = [r["abs_pearson_log1p"] for r in table]
    assert order[-1] is None and order[:-1] == sorted(order[:-1], reverse=True)


def test_contingency_counts_the_joined_rows(clicks, bought):
    joined = join_tracker_orders(clicks, bought)
    want = {(r[0], r[1]): r[2] for r in joined.groupBy("action_type", "last_status").count().collect()}
    table = {(r[0], r[1]): r[2] for r in ops.contingency(clicks, bought).collect()}
    assert {k: v for k, v in table.items() if v} == want
    actions, statuses = {a for a, _ in want}, {s for _, s in want}
    assert set(table) == {(a, s) for a in actions for s in statuses}


def test_statistics_against_numpy(clicks, bought):
    table = ops.contingency(clicks, bought)
    cells = ops.cell_statistics(table).collect()
    rows = sorted({c["action_type"] for c in cells}, key=str)
    cols = sorted({c["last_status"] for c in cells}, key=str)
    seen = np.zeros((len(rows), len(cols)))
    for c in cells:
        seen[rows.index(c["action_type"]), cols.index(c["last_status"])] = c["observed"]
    n = seen.sum()
    want = seen.sum(1, keepdims=True) @ seen.sum(0, keepdims=True) / n
    for c in cells:
        at_cell = rows.index(c["action_type"]), cols.index(c["last_status"])
        assert c["expected"] == pytest.approx(want[at_cell])
        assert c["residual"] == pytest.approx((seen[at_cell] - want[at_cell]) / np.sqrt(want[at_cell] + 1e-12))
        assert c["pmi"] == pytest.approx(np.log((seen[at_cell] / n + 1e-12) / (want[at_cell] / n + 1e-12)))
    strength = ops.cramers_v(table).first()
    chi2 = ((seen - want) ** 2 / (want + 1e-12)).sum()
    assert strength["chi2"] == pytest.approx(chi2)
    assert strength["cramers_v"] == pytest.approx(np.sqrt(chi2 / (n * max(1, min(seen.shape) - 1))))


def test_empty_table_is_an_error(clicks, bought):
    with pytest.raises(Exception, match="empty contingency table"):
        ops.cramers_v(ops.contingency(clicks.where("false"), bought)).collect()


def test_value_counts_and_bounds(spark, clicks):
    assert as_set(ops.value_counts(clicks, "action_type", more_than=1)) == {("page_view", 2), ("to_cart", 2)}
    bounds = ops.time_bounds(clicks, "timestamp").first()
    assert (bounds["first"], bounds["last"]) == (at(1, 5), at(9, 1))
    assert bounds["last_epoch"] - bounds["first_epoch"] == 8 * 86_400 - 4


def test_report(spark, clicks, bought):
    report = association_report(clicks, bought)
    assert report.correlations.count() == 7 and report.rates.count() == 7
    assert report.any_rate.count() == 1 and report.strength.count() == 1
    alone = ops.contingency(clicks, spark.createDataFrame([], ORDERS))
    assert {r["last_status"] for r in alone.collect()} == {None}


def test_missing_is_not_the_text_null(clicks, bought):
    named = clicks.withColumn("action_type", F.when(F.col("action_type") == "remove", "null").otherwise(F.col("action_type")))
    counts = {(r[0], r[1]): r[2] for r in ops.contingency(named, bought).collect()}
    assert counts["null", None] == 1 and counts[None, None] + counts.get((None, "delivered_orders"), 0) >= 1


def test_odd_category_names(clicks, bought):
    odd = clicks.withColumn("action_type", F.concat(F.lit("a'b`c.d\\n"), F.col("action_type")))
    late = bought.withColumn("last_status", F.concat("last_status", F.lit(" x'`y")))
    report = association_report(odd, late)
    assert report.correlations.count() == report.rates.count() == 7
    assert "delivered_orders x'`y" in {r["last_status"] for r in report.cells.collect()}
