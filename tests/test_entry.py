"""Every registered query against its oracle, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_scoring_query_has_an_oracle():
    assert entry.scoring_queries().keys() <= SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_flagship(spark):
    assert entry.entry(spark).count() == 5
