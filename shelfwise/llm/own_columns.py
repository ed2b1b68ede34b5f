"""A document's own columns, kept apart from those that an operator adds under the same names."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keeping(docs: DataFrame, added: Iterable[str], work: Callable[[DataFrame], DataFrame], more: Iterable[str] = ()) -> DataFrame:
    """The columns of ``docs`` after ``work``, and ``more`` of those it added; what ``work`` adds takes the place of none."""
    added, taken = set(added), set(docs.columns)
    aside: dict[str, str] = {}
    for name in docs.columns:
        if name in added:
            other = f"_own_{name}"
            while other in taken:
                other += "_"
            aside[name] = other
            taken.add(other)
    out = work(docs.withColumnsRenamed(aside) if aside else docs)
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns], *more)
