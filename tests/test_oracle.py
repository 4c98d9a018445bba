"""Every registered query with an oracle gives the same rows, columns and types as DuckDB."""

import os

import pytest
from compare import compare, connect

from berthlake.registry import load_all

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES = load_all()
# the models take long; tests/test_forecast.py runs them
SLOW = {"recursive_forecast", "recursive_forecast_biweekly", "forecast_monthly_long", "validate_holdout", "fit_gbt",
        "ensemble_predict", "feature_attribution", "fit_ridge_per_terminal", "validate_holdout_biweekly", "forecast_summary",
        "tree_attribution", "scenario_attribution", "tree_feature_ranking"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    count, problem = compare(spark, con, QUERIES[name], SF)
    assert not problem, problem
    assert count >= 0


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
