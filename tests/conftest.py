from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from helpers import ORDERS, TRACKER, at  # noqa: E402

from shelfwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tables of a few rows: compiling a plan would take longer than interpreting it.
    session = local_session(
        min(8, os.cpu_count() or 4),
        spark__sql__shuffle__partitions="4",
        spark__sql__codegen__wholeStage="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clicks(spark):
    """Repeated events, several actions a day, a missing action, a negative user."""
    rows = [
        (1, 10, at(1, 5), "page_view"),
        (1, 10, at(1, 6), "page_view"),
        (1, 10, at(1, 7), "to_cart"),
        (1, 10, at(3, 1), "favorite"),
        (1, 10, at(9, 1), "view_description"),
        (1, 11, at(2, 1), "review_view"),
        (2, 10, at(2, 2), None),
        (2, 12, at(4, 2), "remove"),
        (-3, 12, at(5, 2), "unfavorite"),
        (-3, 12, at(6, 2), "to_cart"),
    ]
    return spark.createDataFrame([(*r, "w") for r in rows], TRACKER)


@pytest.fixture(scope="session")
def bought(spark):
    """Two orders for one user, item and day; a missing status; orders without a click."""
    rows = [
        (1, 10, at(1), "delivered_orders", at(1, 9)),
        (1, 10, at(1), "canceled_orders", at(1, 10)),
        (1, 11, at(2), None, at(2, 3)),
        (2, 10, at(2), "delivered_orders", at(2, 5)),
        (2, 10, at(2), "delivered_orders", None),
        (2, 12, at(4), "canceled_orders", at(5, 5)),
        (-3, 12, at(6), "delivered_orders", at(6, 5)),
        (7, 99, at(6), "delivered_orders", at(6, 5)),
    ]
    return spark.createDataFrame(rows, ORDERS)


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest given tables."""
    return "/root/testdata/sf0.001"
