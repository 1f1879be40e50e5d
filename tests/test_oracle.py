"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

ORACLES = entry.oracle_sql()
# The queries on texts have tests of their own, by brute force where SQL cannot express them.
QUERIES = {name: function for name, function in entry.queries().items() if name not in entry.LLM or name in ORACLES}


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, folder, name):
    result = QUERIES[name](spark, folder).toArrow()
    assert compare(result, duck.sql(ORACLES[name]).to_arrow_table()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 8
