"""Every registered query against its SQL, and the driver contract."""

import pytest
from check import compare, database

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_contract(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF, queries()[name], oracle_sql()[name]) is None
