"""Scalar expressions: time, ids, null filling, value coercion and names."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86_400


def event_date(ts: str | Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch; an integer column is taken to hold them already.

    Zone-less timestamps are read as they stand, whatever the session time zone.
    """
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
        return F.unix_date(F.to_date(col)).cast("long") * SECONDS_PER_DAY + clock
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(col)
    return col.cast("long")


def _instant(df: DataFrame, name: str, epoch: int) -> Column:
    """``epoch`` as a literal of the column's own type, so comparisons reach the scan."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        stamp = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=epoch)
        return F.expr(f"TIMESTAMP_NTZ'{stamp:%Y-%m-%d %H:%M:%S}'")
    if isinstance(kind, T.TimestampType):
        return F.timestamp_seconds(F.lit(epoch))
    return F.lit(epoch)


def epoch_at_most(df: DataFrame, name: str, epoch: int) -> Column:
    """``epoch_seconds(name) <= epoch`` in a form Parquet can filter on.

    Whole seconds are at most ``epoch`` exactly when the instant lies before ``epoch + 1``.
    """
    return F.col(name) < _instant(df, name, epoch + 1)


def epoch_after(df: DataFrame, name: str, epoch: int) -> Column:
    """``epoch_seconds(name) > epoch`` in a form Parquet can filter on."""
    return F.col(name) >= _instant(df, name, epoch + 1)


def user_bucket(user: str | Column, mod: int, seed: int) -> Column:
    """Deterministic bucket ``(user + seed) mod mod``, never negative."""
    col = F.col(user) if isinstance(user, str) else user
    return F.pmod(col.cast("long") + F.lit(seed).cast("long"), F.lit(mod).cast("long"))


def shard_of(user: str | Column, shards: int) -> Column:
    return user_bucket(user, shards, 0)


def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls become 0 in numeric columns; other columns keep theirs."""
    return df.na.fill(0, subset=columns)


def any_signal(*counts: str | Column) -> Column:
    """True where at least one of the non-negative counts is positive."""
    cols = [F.col(c) if isinstance(c, str) else c for c in counts]
    return reduce(lambda left, right: left.bitwiseOR(right), cols) > 0


def safe_name(text: str) -> str:
    """Column-name form of a category value: lower case, separators as underscores."""
    return text.lower().translate(str.maketrans(" -/", "___"))


def safe_name_of(col: str | Column) -> Column:
    """The same rule as :func:`safe_name`, applied to a column."""
    return F.translate(F.lower(F.col(col) if isinstance(col, str) else col), " -/", "___")


def coerce_value(df: DataFrame, name: str, kind: str) -> Column:
    """Bring a column to one of four feature kinds.

    ``float`` / ``token`` give a scalar (a list gives its first element) and
    ``float_seq`` / ``token_seq`` a list (a scalar becomes a list of one). Nulls and
    values that do not parse become 0, a missing list becomes an empty one.
    """
    scalar = {"float": "float", "float_seq": "float", "token": "bigint", "token_seq": "bigint"}.get(kind)
    if scalar is None:
        raise ValueError(f"unknown feature kind {kind!r}")
    zero = F.lit(0).cast(scalar)
    col = F.col(name)
    is_list = isinstance(df.schema[name].dataType, T.ArrayType)
    if kind.endswith("_seq"):
        empty = F.array().cast(f"array<{scalar}>")
        if is_list:
            return F.coalesce(F.transform(col, lambda v: F.coalesce(v.try_cast(scalar), zero)), empty)
        return F.when(col.isNull(), empty).otherwise(F.array(F.coalesce(col.try_cast(scalar), zero)))
    value = F.try_element_at(col, F.lit(1)) if is_list else col
    return F.coalesce(value.try_cast(scalar), zero)


def lenient_label(name: str) -> Column:
    """Label as float; text that is not a number becomes null."""
    return F.col(name).try_cast("float")


def lenient_day(df: DataFrame, name: str) -> Column:
    """Days since the epoch as an integer; values that are no date become null."""
    if isinstance(df.schema[name].dataType, T.DateType):
        return F.unix_date(F.col(name))
    return F.unix_date(F.col(name).try_cast("date"))
