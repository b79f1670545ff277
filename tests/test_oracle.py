"""Every query with an SQL twin gives the same rows, names and types."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
RUN, TWIN = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWIN))
def test_matches_sql(spark, duck, name):
    assert compare(RUN[name](spark, FOLDER), duck, TWIN[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10


def test_names_are_plain():
    assert set(TWIN) <= set(RUN)
    assert all(n == n.lower() and " " not in n for n in RUN)
