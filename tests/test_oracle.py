"""Every registered query against its SQL twin on the given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from claimworks.oracle import ORACLE_SQL
from claimworks.queries import QUERIES
from oracle_compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert QUERIES.items() <= entry_points.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    assert difference(frame, connection, entry_points.oracle_sql()[name]) is None


def test_comparison_notices_differences(spark, connection):
    frame = entry_points.queries()["clean_city"](spark, SF_DIR)
    sql = entry_points.oracle_sql()["clean_city"]
    assert "rows" in difference(frame, connection, sql + " where population > 2000")
    assert "types" in difference(frame.drop("zips"), connection, sql)
    changed = sql.replace("1000 * (n_nationkey", "1001 * (n_nationkey")
    assert difference(frame, connection, changed) is not None


def test_entry_is_the_city_report(spark):
    assert entry_points.entry(spark).count() == 82
