"""Models by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shelfwise.models.als import fit_als
from shelfwise.models.bpr import fit_bpr
from shelfwise.models.factors import FactorModel

MODELS: dict[str, Callable[..., FactorModel]] = {"als": fit_als, "bpr": fit_bpr}


def fit_model(name: str, ratings: DataFrame, user_map: DataFrame, item_map: DataFrame, **params) -> FactorModel:
    """Fit a model by name; unknown names are an error."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; expected one of {sorted(MODELS)}")
    return MODELS[name](ratings, user_map, item_map, **params)
