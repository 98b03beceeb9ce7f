"""Every query with SQL gives the same rows as its SQL."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference, spark_bag, sql_bag

DATA = "/root/testdata/sf0.001"
EXPECTED = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, con, name):
    got = spark_bag(entry_module.queries()[name](spark, DATA))
    assert difference(got, sql_bag(con, EXPECTED[name])) == ""


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


def test_every_sql_has_a_query():
    assert set(EXPECTED) <= set(entry_module.queries())
