"""Queries beside their SQL twins on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connection

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toPandas()
    assert compare(got, con.execute(SQL[name]).df()) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["q", "n", "pct_hit", "pct_exito"]
