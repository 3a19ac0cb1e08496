"""Every query with an oracle, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return connect(small)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, db, name):
    assert difference(contract.queries()[name](spark, small), db, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
