"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare
from freshet.catalog import all_queries, all_sql


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["window_start", "window_end", "n"]


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, con, data, name):
    good, text = compare(spark, con, name, data)
    assert good, text
