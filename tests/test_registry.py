"""Every core query against its SQL on the smallest data, and the contract of the entry module."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, same
from tidemark.plans import registry

FOLDER = "/root/testdata/sf0.001"
#: Queries that SQL can't express: a sequential sampler, an eigenvector's sign.
NO_SQL = {"g04_accept_reject", "g05_running_uid", "w13_pca_loadings", "w13_pca_scores"}
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_every_core_query_has_sql_or_a_reason():
    assert set(registry.queries()) - set(registry.oracle_sql()) == NO_SQL
    assert not set(registry.oracle_sql()) - set(registry.queries())


def test_entry_contract():
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@there
def test_flagship(spark):
    assert entry.entry(spark).count() >= 3


@pytest.fixture(scope="module")
def base():
    return connect(FOLDER)


@there
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, base, name):
    same(spark, base, FOLDER, registry.queries()[name], registry.oracle_sql()[name])


@there
@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, FOLDER).count() >= 0


def test_core_does_not_know_the_subpackage():
    top = os.path.dirname(os.path.dirname(registry.__file__))
    for root, _, names in os.walk(top):
        if os.path.relpath(root, top).split(os.sep)[0] != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "tidemark.llm" not in open(os.path.join(root, n)).read(), n
