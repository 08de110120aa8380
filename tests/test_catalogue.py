"""Batch form of every operator against SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from millrace.plans.catalogue import QUERIES, SQL
from tests.compare import difference, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SMALL)
    assert difference(df, con, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert contract.queries().keys() >= QUERIES.keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
