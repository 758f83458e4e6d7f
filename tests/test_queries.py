"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks import ORACLES, QUERIES
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert difference(spark, con, sf, name) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_few_queries_lack_sql():
    assert sorted(set(QUERIES) - set(ORACLES)) == ["d21_mean_latency", "h04_binary_head"]
