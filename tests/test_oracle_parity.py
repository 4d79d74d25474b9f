"""Spark query vs DuckDB SQL on the same parquet (sf0.001), like the driver's gate."""

import math

import pytest

from tests.conftest import SF_TINY

FAST_KEYS = [
    "classification_report", "confusion_matrix", "confusion_matrix_norm", "accuracy", "macro_metrics",
    "focus_metrics", "weighted_metrics", "fbeta_metrics", "metrics_long", "percentile_breakdown",
    "percentile_breakdown_allpos", "precision_buckets", "score_percentiles", "roc_curve", "pr_curve",
    "roc_auc", "roc_auc_hard", "roc_auc_macro", "label_binarize", "argmax_class",
    "scan_table", "prep_columns", "with_actual", "drop_columns", "align_features", "tag_literals",
    "safe_names", "target_distribution", "target_distribution_nulls", "class_list", "class_imbalance",
    "stratified_split", "stratified_kfold", "split_shapes", "label_encode", "under_sample", "over_sample",
    "smote", "sampling_plan", "model_combos", "hp_trials", "trial_grid", "split_combo", "knn_classify",
    "parse_feature_list", "parse_params", "format_ts", "ensemble_max", "ensemble_vote", "union_all",
    "join_actuals", "attach_scores", "history_fallback", "registry_lookup", "mode_values", "impute_mode",
    "describe_features", "describe_by_split", "distribution_compare", "fit_nb",
    "percentile_breakdown_by_model", "metrics_long_train_val", "odd_names", "registry_lookup_key",
    "hp_trials_stored", "rescore_replaces", "ovr_os", "smote_nulls", "fit_rf", "fit_dt", "fit_gbt",
    "feature_importance", "model_roundtrip", "job_report", "loss_curve", "cross_validator",
    "smote_lsh", "job_auc_hard", "job_allpos", "job_run_log", "job_run_kinds", "replace_key_by_nothing", "ensemble_models", "grouped_linear",
    "keyed_upsert", "replace_by_key", "csv_roundtrip", "run_log", "write_results", "score", "score_stored",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", FAST_KEYS)
def test_parity(spark, duck, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_TINY)
    cols = df.columns
    got = _rows(cols, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = _rows(cols, [tuple(r[i] for i in idx) for r in cur.fetchall()])
    assert got == exp


def test_every_sql_key_is_registered():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 4
    assert df.columns == ["value", "precision", "recall", "f1_score", "support"]
