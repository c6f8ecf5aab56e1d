"""Every registered query of the warehouse against its SQL, both on the smallest tables.

The training-data queries can't be said in SQL; their own tests hold them against brute force.
"""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from chronostar.catalog import queries as registered

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(SQL) <= set(entry.queries())


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "quarter", "revenue", "sales"]
    assert df.count() > 0
