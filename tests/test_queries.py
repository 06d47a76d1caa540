"""Every registered query against its SQL text."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry_points.QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name, entry_points.QUERIES[name]) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).limit(1).count() == 1
