"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert set(entry.oracle_sql()) >= set(entry.queries()) - set(entry.LLM)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, sf_dir, name):
    found = differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert [f for f in found if not f.startswith("note")] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
