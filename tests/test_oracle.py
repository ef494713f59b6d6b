"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import check, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, message, _ = check(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0
