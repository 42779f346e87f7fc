"""Every registered query against its SQL, on whole small tables."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry
from cohortflow.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, connection, SQL[name]) is None
