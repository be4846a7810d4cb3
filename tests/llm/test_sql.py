"""Registered queries against their SQL on the smallest tables."""

import pytest

from tests.compare import connect, difference
from tickloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_matches_sql(spark, name):
    assert difference(connect(SF), queries.QUERIES[name](spark, SF), queries.SQL[name]) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
