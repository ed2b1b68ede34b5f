"""Interaction labels as SQL expressions of an action and an order status.

A label names no columns of its own. Over columns it labels rows; over literals it gives
the weight of one (action, status) combination, which is how the pre-aggregated operators
label whole days of events at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status and action names of the event logs.
DELIVERED = "delivered_orders"
CANCELED = "canceled_orders"

# Weights of the graded label, strongest signal first.
DELIVERED_WEIGHT = 5.0
ACTION_WEIGHTS = {"to_cart": 3.0, "favorite": 3.0, "view_description": 1.0, "review_view": 1.0}


@dataclass(frozen=True)
class Label:
    """SQL template over ``{action}`` and ``{status}``, cast to ``kind``."""

    template: str
    kind: str = "float"

    @property
    def actions(self) -> tuple[str, ...]:
        """Actions the label compares with; all others are alike to it.

        They are told from comparisons with ``=``, ``<>``, ``!=`` and ``IN``; a label that looks
        at its action in any other way is an error, since its days could not be counted.
        """
        listed = re.findall(r"\{action\}\s+IN\s*\(([^)]*)\)", self.template, re.IGNORECASE)
        named = re.findall(r"\{action\}\s*(?:=|<>|!=)\s*'([^']*)'", self.template)
        if self.template.count("{action}") != len(listed) + len(named):
            raise ValueError(f"which actions does {self.template!r} tell apart? Compare {{action}} by =, <>, != or IN")
        return tuple(dict.fromkeys([*named, *(n for part in listed for n in re.findall(r"'([^']*)'", part))]))

    def sql(self, action: str = "action_type", status: str = "last_status") -> str:
        return f"CAST({self.template.format(action=action, status=status)} AS {self.kind})"

    def column(self, action: str = "action_type", status: str = "last_status") -> Column:
        return F.expr(self.sql(action, status))


def _graded(delivered: float, weights: dict[str, float]) -> str:
    """The first matching rule decides: delivered, then the actions in the given order."""
    rules = [f"WHEN {{status}} = '{DELIVERED}' THEN {delivered}D"]
    rules += [f"WHEN {{action}} = '{name}' THEN {weight}D" for name, weight in weights.items()]
    return f"CASE {' '.join(rules)} ELSE 0D END"


_IS_DELIVERED = f"({{status}} = '{DELIVERED}')"
_IS_TO_CART = "({action} = 'to_cart')"

RATING_LABELS: dict[str, Label] = {
    "to_cart_and_delivered": Label(f"({_IS_TO_CART} AND {_IS_DELIVERED})"),
    "to_cart": Label(_IS_TO_CART),
    # Null, not 0, where there is no order.
    "delivered": Label(_IS_DELIVERED),
    # Graded weight of the strongest signal.
    "combined": Label(_graded(DELIVERED_WEIGHT, ACTION_WEIGHTS)),
    "combined2": Label(_graded(1.0, {"to_cart": 1.0, "favorite": 1.0})),
}

# Binary targets of the feature table.
TARGET_LABELS: dict[str, Label] = {
    "delivered": Label(_IS_DELIVERED, "tinyint"),
    "combined": Label(_graded(1.0, {"to_cart": 1.0}), "tinyint"),
}


def rating_label(name: str) -> Label:
    """Label used for rating tables; unknown names are an error."""
    if name not in RATING_LABELS:
        raise ValueError(f"unknown label {name!r}; expected one of {sorted(RATING_LABELS)}")
    return RATING_LABELS[name]


def target_label(name: str) -> Label:
    """Label used for the training target; unknown names are an error."""
    if name not in TARGET_LABELS:
        raise ValueError(f"unknown target {name!r}; expected one of {sorted(TARGET_LABELS)}")
    return TARGET_LABELS[name]
