"""Every registered query with a SQL form must agree with it at the smallest scale."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# Long replays and fits; the same checks run at a larger scale outside the tests.
SLOW = {"energy_cluster", "model_save_load", "model_metrics", "metric_drift", "stream_nearest_scada", "noise_share", "stream_units_weekly"}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in SQL if n not in SLOW])
def test_agrees_with_sql(spark, connection, name):
    assert oracle.difference(entry.queries()[name](spark, FOLDER), connection, SQL[name]) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["machine_id", "period", "efficiency_pct"] and result.count() > 0
