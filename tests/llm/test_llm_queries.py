"""The pN_ queries: with SQL against DuckDB on the smallest tables; the others run."""

import pytest

import __spark_entry__ as entry
from textloom.llm import queries as llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(agrees, name):
    agrees(llm.queries()[name], llm.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_runs(spark, small, name):
    assert llm.queries()[name](spark, small).count() >= 0


def test_registered():
    assert set(llm.queries()) <= set(entry.queries())
