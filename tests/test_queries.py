"""Every registered query against its SQL check."""

import pytest

import __spark_entry__ as contract
from contrail.plans import catalogue, checks
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_query_has_a_check():
    assert set(catalogue.queries()) == set(checks.oracle_sql())
    assert set(catalogue.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(name, spark, folder, connection):
    frame = contract.queries()[name](spark, folder)
    assert differences(frame, connection, contract.oracle_sql()[name]) == []


def test_entry(spark):
    from contrail import contracts as C
    frame = contract.entry(spark)
    assert frame.columns == C.GOLD.names
    assert frame.count() > 0
