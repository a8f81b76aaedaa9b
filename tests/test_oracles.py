"""Every registered query against its SQL on the smallest sample."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tidestar import suite

SF_DIR = entry.SMALL
QUERIES, SQL = suite.queries(), suite.oracle_sql()


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_names():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["name", "category", "total"]
    assert df.count() > 0
