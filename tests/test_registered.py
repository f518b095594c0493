"""Every registered query against its SQL on the whole small tables."""

import pytest

import __spark_entry__ as registry
from tests.oracle import compare, connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


# The training-data queries have their own tests beside the other tests of that folder.
OWN = sorted(n for n, run in registry.queries().items() if not run.__module__.startswith(("nearspan.llm", "corpus_pipeline")))


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) is None


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 100
    assert {r["lang"] for r in rows} == {"en"}


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
