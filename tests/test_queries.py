"""Every query with an SQL equivalent gives the same rows in a second engine."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, difference
from checks.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
# Queries whose thresholds let nothing through, or leave nothing to learn from, at the smallest size.
LARGER = "/root/testdata/sf0.01"
NEED_MORE = {
    "ltv_group_gate", "null_targets", "predictions_long", "cascade_outcomes", "forecast_future", "gbt_group_mean", "gbt_multi_group_mean",
    "gbt_importance_of_the_target", "ltv_results_table", "risk_all_combinations",
}


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(NEED_MORE))
def test_query_matches_sql_on_more_rows(spark, name):
    assert difference(spark, connect(LARGER), LARGER, name) is None


@pytest.mark.parametrize("name", sorted(set(ORACLE) - NEED_MORE))
def test_query_matches_sql(spark, db, name):
    assert difference(spark, db, SF, name) is None


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) >= set(QUERIES)
