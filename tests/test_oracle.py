"""Every query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_points
from checking import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def checker():
    return connect(FOLDER)


def test_every_query_of_the_library_has_sql():
    assert set(SQL) <= set(QUERIES)
    own = {n for n in QUERIES if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(SQL)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["skill", "frequency"] and df.count() == 25


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, checker, name):
    assert compare(QUERIES[name](spark, FOLDER), checker, SQL[name]) is None
