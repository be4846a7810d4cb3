"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.compare import connect, difference
from tickloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(con, catalog.QUERIES[name](spark, SF), catalog.SQL[name]) is None
