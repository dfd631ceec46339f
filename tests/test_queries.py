"""Every named query against its SQL, on whole tables of the smallest data set."""

import pytest

import __spark_entry__ as entry
from larkspur.plans import QUERIES as PLAN_QUERIES
from larkspur.plans import SQL as PLAN_SQL
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# the queries of larkspur.llm have tests of their own
QUERIES, SQL = PLAN_QUERIES, PLAN_SQL
# few orders and events at this size, so these may find nothing
MAY_BE_EMPTY = True


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message = compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR)
    assert ok or (MAY_BE_EMPTY and message == "empty result"), message
