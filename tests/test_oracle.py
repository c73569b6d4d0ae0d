"""Every registered query against its SQL twin on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tallyforge.plans import QUERIES  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

DATA = os.environ.get("TALLYFORGE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no SQL twin"
    _, problems = compare(entry.queries()[name](spark, DATA), duck, sql)
    assert not problems


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
