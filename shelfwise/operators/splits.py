"""Train / validation splits and user slices."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expressions import epoch_after, epoch_at_most, user_bucket

# A slice of users is sent to every task; beyond this many it is joined by shuffle.
BROADCAST_USERS = 1_000_000


class Split(NamedTuple):
    train: DataFrame
    valid: DataFrame | None


def time_split(df: DataFrame, ts: str, train_end: int, valid_end: int) -> Split:
    """Train up to ``train_end``, validation after it and up to ``valid_end`` (epoch seconds)."""
    train = df.where(epoch_at_most(df, ts, train_end))
    valid = df.where(epoch_after(df, ts, train_end) & epoch_at_most(df, ts, valid_end))
    return Split(train, valid)


def time_user_split(
    df: DataFrame,
    ts: str,
    train_end: int,
    valid_end: int,
    valid_ratio: float = 0.2,
    mod: int = 1000,
    seed: int = 17,
    user: str = "user_id",
) -> Split:
    """Time split over disjoint users: low buckets validate, the others train."""
    threshold = int(valid_ratio * mod)
    bucket = user_bucket(user, mod, seed)
    train, valid = time_split(df, ts, train_end, valid_end)
    return Split(train.where(bucket >= threshold), valid.where(bucket < threshold))


def only_train(df: DataFrame) -> Split:
    return Split(df, None)


def make_split(df: DataFrame, ts: str, kind: str = "time_split", **params) -> Split:
    """Split by name; unknown names are an error."""
    kinds = {"time_split": time_split, "time_user_split": time_user_split}
    if kind == "only_train":
        return only_train(df)
    if kind not in kinds:
        raise ValueError(f"unknown split {kind!r}; expected one of {sorted([*kinds, 'only_train'])}")
    return kinds[kind](df, ts, **params)


def first_users(df: DataFrame, n: int, user: str = "user_id") -> DataFrame:
    """The ``n`` smallest distinct user ids."""
    return df.select(user).distinct().orderBy(user).limit(n)


def keep_users(df: DataFrame, users: DataFrame, n: int, user: str = "user_id") -> DataFrame:
    """Rows of the users in a slice of at most ``n`` users, which holds the broadcast to its bound."""
    side = F.broadcast(users.limit(n)) if n <= BROADCAST_USERS else users
    return df.join(side, user, "left_semi")


def cap_users(users: DataFrame, limit: int | None, user: str = "user_id") -> DataFrame:
    """Distinct users, only the first ``limit`` by id where a positive limit is given."""
    if limit is None or limit <= 0:
        return users.select(user).distinct()
    return first_users(users, limit, user)
