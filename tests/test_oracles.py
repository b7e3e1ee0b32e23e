"""Every query with oracle SQL agrees with DuckDB on the smallest tables."""

import pytest

from conftest import SF
from oracle import connect, difference
from wideloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
