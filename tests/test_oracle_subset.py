"""A representative slice of the driver's check: Spark query vs DuckDB oracle
(row count, column names, order-insensitive values) on the smallest tables."""

import pytest

from .conftest import SF_SMALL
from .oracle_check import compare, duck

SUBSET = ["clean_strings", "na_tokens", "feature_builder", "dup_rows", "null_profile",
          "iqr_outliers", "eta_squared", "target_hist", "template_check", "split_80_20",
          "kfold_nested", "standard_scale", "onehot_rare", "fold_params", "ols_oof",
          "metrics_by_quartile", "calibration_cv", "grid_blend", "median_prune",
          "early_stop", "nested_bag", "holdout_metrics", "table_digest", "dup_events",
          "ridge_design_oof", "stack_board", "candidate_cv", "search_space", "score_from_artifacts"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as entry
    ok, rows, _, detail = compare(spark, con, name, entry.queries()[name],
                                  entry.oracle_sql()[name], SF_SMALL)
    assert ok, detail
