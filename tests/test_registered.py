"""Every registered query against its SQL, on the smallest given tables."""

import oracle
import pytest

from shelfwise.catalog.oracles import ORACLES
from shelfwise.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


# Flag columns depend on which values pass the cut; their SQL is written for a larger scale.
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, small, name):
    assert oracle.compare(spark, con, QUERIES[name], ORACLES[name], small) is None


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 6
