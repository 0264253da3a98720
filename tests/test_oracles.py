"""Every registered query against its oracle on the smallest tables."""

import pytest

from contract import load
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


# Reports that are empty on the smallest tables.
EMPTY = {"q06_overlap"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, connection, name):
    problem = differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name])
    assert problem == ("no rows" if name in EMPTY else ""), problem


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == [
        "rank", "source", "title", "raw_score", "composite_score", "url",
    ]
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
