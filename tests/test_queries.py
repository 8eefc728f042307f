"""Every query with a SQL twin gives the same rows as DuckDB on the smallest tables; the others give rows."""

import pytest
from oracle import compare, duck

from pricewright.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
PLANS = ["blend_plan", "stack_plan"]  # their fits are proven by blend_plan_checks and stack_plan_checks


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(PLANS)))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_every_twin_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
