"""Every registered query against its SQL."""

import pytest
from conftest import SF_DIR
from oracle import compare, connect

import __spark_entry__ as contract
from tidegate.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_states_its_result():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    equal, message = compare(contract.queries()[name](spark, SF_DIR), db, contract.oracle_sql()[name])
    assert equal, message


def test_entry(spark):
    assert contract.entry(spark).count() > 0
