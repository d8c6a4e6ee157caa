"""Every query with SQL against DuckDB on the smallest tables; the others run."""

import pytest

import __spark_entry__ as entry
from textloom import queries as core


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_sql(agrees, name):
    agrees(core.queries()[name], core.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_runs(spark, small, name):
    assert core.queries()[name](spark, small).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
