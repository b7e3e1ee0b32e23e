"""Queries of this folder that SQL can express, against DuckDB on the smallest tables."""

import pytest

from oracle import connect, difference
from wideloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
