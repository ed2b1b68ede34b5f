"""Factor models and the registry both jobs use."""

from shelfwise.models.registry import MODELS, fit_model

__all__ = ["MODELS", "fit_model"]
