"""Every query with a SQL twin gives the twin's rows; the others run."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_check import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == "ok"


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    row = entry.entry(spark).first()
    assert row.total_records == row.high_risk_count + row.medium_risk_count + row.low_risk_count > 0


@pytest.mark.parametrize("name", ["matrix_export", "tree_importances"])
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
