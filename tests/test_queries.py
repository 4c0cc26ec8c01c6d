"""Every registered query against its expected SQL."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, differences
from workload.expected import EXPECTED
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_expected_sql():
    assert QUERIES.keys() == EXPECTED.keys()
    assert contract.queries().items() >= QUERIES.items() and contract.oracle_sql().items() >= EXPECTED.items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert differences(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
