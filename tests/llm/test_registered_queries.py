"""Every registered training-data query on the whole small tables, against its SQL where there is some."""

import pytest

import __spark_entry__ as registry
from nearspan.llm import queries
from tests.oracle import compare, connection

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14)) and "pipeline" in registry.queries()
