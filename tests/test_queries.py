"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as contract
from checks import GROUPS
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = {name: q for group in GROUPS for name, q in group.QUERIES.items()}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["pid", "code", "display", "value", "date"]
