import pytest

import __spark_entry__ as entry_points
from conftest import SMALL
from oracle_compare import connect, difference
from recordloom.plans.queries import QUERIES

ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    assert difference(entry_points.queries()[name](spark, SMALL), tables, ORACLES[name]) is None


def test_entry(spark):
    assert sum(r["n"] for r in entry_points.entry(spark).collect()) == 200
