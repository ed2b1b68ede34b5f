"""Exploratory report: how actions go with order outcomes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from shelfwise.operators.association import (
    any_signal_rate,
    cell_statistics,
    contingency,
    cramers_v,
    label_correlation,
    pair_features,
    signal_rates,
)
from shelfwise.operators.interactions import category_values


class AssociationReport(NamedTuple):
    correlations: DataFrame
    rates: DataFrame
    any_rate: DataFrame
    cells: DataFrame
    strength: DataFrame


# Actions taken together as "any sign of interest".
INTEREST_ACTIONS = ("favorite", "to_cart", "review_view", "view_description")


def association_report(tracker: DataFrame, orders: DataFrame) -> AssociationReport:
    """All association tables of a pair of logs."""
    actions = category_values(tracker, "action_type")
    pairs = pair_features(orders, tracker, actions)
    table = contingency(tracker, orders)
    interest = [a for a in INTEREST_ACTIONS if a in actions]
    return AssociationReport(
        label_correlation(pairs, actions),
        signal_rates(pairs, actions),
        any_signal_rate(pairs, interest or actions),
        cell_statistics(table),
        cramers_v(table),
    )
