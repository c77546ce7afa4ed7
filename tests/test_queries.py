"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.queries import QUERIES
from helpers import plan


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_without_cross_join(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    text = plan(result)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert compare(spark, con, sf_dir, name, result) == ""


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
