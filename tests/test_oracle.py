"""Spark query == DuckDB oracle (row multiset, column names) on sf0.001."""

import math

import pytest

from tests.conftest import SMALL

FAST = ["typed_projection", "display_rename", "null_profile", "mean_impute", "stratified_split",
        "second_split", "kfold", "score_fixed", "metrics_by_split", "fold_mean", "logloss",
        "summary_stats", "histogram_by_class", "box_by_class", "violin_density", "marginal_box", "marginal_violin", "corr_matrix",
        "ols_trend", "negative_split", "request_validation", "trial_draws", "best_trial",
        "request_validation", "stream_rejected", "csv_typed_scan", "batch_predict", "scatter_records", "record_head",
        "table_shape", "promote_best", "part_sizes", "search_trials", "leaderboard", "best_version", "gap_free_versions", "current_stage", "early_stop",
        "minmax_scale", "prediction_log_daily", "stream_score", "stream_json_requests", "stream_monitor", "rf_importance", "gbt_train_eval", "search_steps",
        "logit_importance", "logit_importance_l1", "logit_scores", "model_lifecycle"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_every_query_has_entry():
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 45


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SMALL)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, sdf.collect()) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert {r["split"] for r in rows} == {"train", "test"}
    assert set(df.columns) >= {"tp", "fp", "tn", "fn", "accuracy", "precision", "recall", "f1"}
