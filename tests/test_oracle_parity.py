"""Registered queries against their DuckDB SQL on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_util import compare, duck

SAMPLE = [
    "sales_by_country", "top_partners", "monthly_sales", "amount_histogram", "amount_kde", "amount_q95",
    "profile_table", "sales_by_weekday", "kpi_totals", "kpi_precision", "daily_long", "store_breakdown",
    "filter_options", "preview_rows", "load_sales", "load_csv_dir", "load_pred_vs_real", "validate_sales",
    "row_rules", "store_list_filter", "recent_sample", "feat_all", "feature_lists", "bfill_ffill_zero",
    "preprocess_pipeline", "iqr_fit_transform", "temporal_split", "standard_scale", "reg_metrics",
    "quality_distribution", "training_summary", "top5_stores", "backtest_metrics", "bulk_forecast",
    "forecast_totals", "future_template", "future_extras", "feature_variability", "sink_forecast_csv",
    "run_log", "run_list", "best_runs", "best_store_models", "experiment_list", "store_forest", "feature_importance",
    "train_all_stores", "model_registry", "forecast_store", "bulk_forecast_forest", "generate_forecast",
    "backtest_forest", "run_log_forest", "store_forest_pooled", "store_forest_splits", "store_forest_predictions",
    "forecast_recursive", "generate_forecast_recursive", "feat_all_clustered", "feat_incremental",
    "model_registry_versions", "available_stores_latest", "validate_sales_written",
    "quantiles_incremental", "iqr_incremental",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    from storecast.plans import catalog
    assert set(catalog.QUERIES) <= set(sqls)


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_duckdb(spark, con, key):
    compare(spark, con, E.queries()[key], E.oracle_sql()[key], SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "billings_autocorr_30" in df.columns
