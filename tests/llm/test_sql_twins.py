"""Every training-data query that has SQL, against it."""

import pytest

import __spark_entry__ as entry_points
from claimworks.llm import queries
from oracle_compare import connect, difference


def test_sql_is_of_registered_queries():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    assert difference(frame, connect(sf_dir), entry_points.oracle_sql()[name]) is None
