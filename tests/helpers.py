"""What the tests share besides fixtures."""

from __future__ import annotations

import datetime as dt

TRACKER = "user_id bigint, item_id bigint, timestamp timestamp_ntz, action_type string, action_widget string"
ORDERS = (
    "user_id bigint, item_id bigint, created_timestamp timestamp_ntz, last_status string, "
    "last_status_timestamp timestamp_ntz"
)


def at(day: int, second: float = 0) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, seconds=second)


def as_set(df, *columns):
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)
