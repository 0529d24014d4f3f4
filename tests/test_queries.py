"""Every query with SQL gives exactly the rows of that SQL; the others give rows."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    if name in SQL:
        assert differences(result, con, SQL[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())
