"""The subpackage's queries against their SQL on the smallest data."""

import os

import pytest

from tests.compare import connect, same
from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, base, name):
    same(spark, base, FOLDER, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() > 0
