"""Registered queries: one per operator key of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` (whole tables, no sampling) and returns a lazy DataFrame. Column
names equal those of the matching DuckDB SQL in :mod:`tabclass.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import balance, prep
from .plans import buckets, curves, metrics
from .sources import fixtures as fx

FOCUS = ("purchase", "signup")   # focus labels used with F_SCORED
BETA = 0.5                       # accuracy focus 'precision' -> F0.5

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    from . import queries_ml, queries_more  # noqa: F401  (register the remaining keys)
    return dict(_REGISTRY)


def _cm(spark, sf_dir):
    return metrics.confusion_counts(fx.f_scored(spark, sf_dir))


# ---------------------------------------------------------------- evaluation
@register("classification_report")
def q_classification_report(spark, sf_dir):
    return metrics.classification_report(_cm(spark, sf_dir))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return metrics.dense_confusion(_cm(spark, sf_dir))


@register("confusion_matrix_norm")
def q_confusion_matrix_norm(spark, sf_dir):
    return metrics.normalized_confusion(_cm(spark, sf_dir))


@register("accuracy")
def q_accuracy(spark, sf_dir):
    return metrics.summary(_cm(spark, sf_dir)).select(F.round("accuracy", 4).alias("accuracy"))


@register("macro_metrics")
def q_macro(spark, sf_dir):
    s = metrics.summary(_cm(spark, sf_dir))
    return s.select(*[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@register("focus_metrics")
def q_focus(spark, sf_dir):
    s = metrics.summary(_cm(spark, sf_dir), labels=FOCUS)
    return s.select(*[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@register("weighted_metrics")
def q_weighted(spark, sf_dir):
    s = metrics.summary(_cm(spark, sf_dir), focus=FOCUS)
    cols = ("weighted_precision", "weighted_recall", "weighted_f1")
    return s.select(*[F.round(c, 4).alias(c) for c in cols],
                    *[F.round(f"focus_{c}", 4).alias(f"focus_{c}") for c in cols])


@register("fbeta_metrics")
def q_fbeta(spark, sf_dir):
    cm = _cm(spark, sf_dir)
    out = None
    for b in (0.5, 1.0, 2.0):
        one = metrics.summary(cm, beta=b, focus=FOCUS).select(
            F.lit(b).alias("beta"), F.round("fbeta", 4).alias("overall_fbeta"),
            F.round("focus_fbeta", 4).alias("fbeta"))
        out = one if out is None else out.unionByName(one)
    return out


@register("metrics_long")
def q_metrics_long(spark, sf_dir):
    scored = fx.f_scored(spark, sf_dir)
    s = metrics.summary(metrics.confusion_counts(scored), beta=BETA, focus=FOCUS)
    auc = curves.roc_auc_macro(scored, fx.SCORE_CLASSES).first()["auc_macro"]  # one number
    return metrics.metric_table({
        "test_recall": F.col("focus_recall"), "test_precision": F.col("focus_precision"),
        "test_f1": F.col("focus_f1"), "test_f_beta": F.col("focus_fbeta"),
        "test_auc": F.round(F.lit(float(auc)), 2),
        "test_overall_recall": F.col("recall"), "test_overall_precision": F.col("precision"),
        "test_overall_f1": F.col("f1"), "test_overall_fbeta": F.col("fbeta"),
        "test_accuracy": F.col("accuracy")}, s, digits=3)


@register("metrics_long_train_val")
def q_metrics_long_train_val(spark, sf_dir):
    """The 20 rows of train and validation, one confusion aggregate for both."""
    from .plans import evaluate
    scored = fx.f_scored(spark, sf_dir).withColumn(
        "set", F.when(F.col("id") % 3 == 0, "validation").otherwise("train"))
    auc = curves.roc_auc_macro(scored, fx.SCORE_CLASSES, keys=["set"]).withColumnRenamed("auc_macro", "auc")
    return evaluate.metrics_long(metrics.confusion_counts(scored, keys=["set"]), auc, FOCUS, BETA)


@register("percentile_breakdown_by_model")
def q_percentile_breakdown_by_model(spark, sf_dir):
    """The breakdown of E7 for every model id, each with its own thresholds."""
    scored = fx.f_scored(spark, sf_dir).withColumn("model_id", F.concat(F.lit("m"), (F.col("id") % 2).cast("string")))
    return buckets.percentile_breakdown_by(scored, "model_id", FOCUS)


@register("odd_names")
def q_odd_names(spark, sf_dir):
    """Class names with a quote and a dot: macro AUC, a score quantile and a
    described column of such names."""
    from .functions.quantiles import exact_quantiles
    s = fx.f_scored(spark, sf_dir)
    s = s.withColumnRenamed("click", "it's").withColumnRenamed("view", "yes.1")
    s = s.withColumn("actual", F.when(F.col("actual") == "click", "it's").when(F.col("actual") == "view", "yes.1")
                     .otherwise(F.col("actual")))
    names = ["it's" if c == "click" else "yes.1" if c == "view" else c for c in fx.SCORE_CLASSES]
    median = exact_quantiles(s, "yes.1", [0.5])[0]
    return curves.roc_auc_macro(s, names).select(F.round("auc_macro", 6).alias("auc_macro"),
                                                 F.round(F.lit(median), 6).alias("median"))


@register("score_percentiles")
def q_score_percentiles(spark, sf_dir):
    from .config import BREAKDOWN_CUTS
    from .functions.quantiles import exact_quantiles
    scored = fx.f_scored(spark, sf_dir)
    vals = exact_quantiles(scored, FOCUS[0], BREAKDOWN_CUTS)
    rows = [(float(q), float(v)) for q, v in zip(BREAKDOWN_CUTS, vals)]
    return spark.createDataFrame(rows, "q double, value double").select(
        "q", F.round("value", 6).alias("value"))


@register("percentile_breakdown")
def q_percentile_breakdown(spark, sf_dir):
    return buckets.percentile_breakdown(fx.f_scored(spark, sf_dir), FOCUS)


@register("percentile_breakdown_allpos")
def q_percentile_breakdown_allpos(spark, sf_dir):
    return buckets.percentile_breakdown(fx.f_scored(spark, sf_dir), FOCUS, all_positive=True)


@register("precision_buckets")
def q_precision_buckets(spark, sf_dir):
    b = buckets.precision_buckets(fx.f_scored(spark, sf_dir), FOCUS)
    return b.withColumn("percentile_value", F.round("percentile_value", 6))


@register("argmax_class")
def q_argmax(spark, sf_dir):
    return fx.f_scored(spark, sf_dir).select("id", "pred")


@register("label_binarize")
def q_label_binarize(spark, sf_dir):
    from .operators.encode import label_binarize
    return label_binarize(fx.f_scored(spark, sf_dir).select("id", "actual"), "actual", fx.SCORE_CLASSES)


@register("roc_curve")
def q_roc_curve(spark, sf_dir):
    c = curves.roc_curve(fx.f_scored2(spark, sf_dir), "click", "click")
    return c.select(F.round("threshold", 6).alias("threshold"), F.round("fpr", 6).alias("fpr"),
                    F.round("tpr", 6).alias("tpr"), "tps", "fps")


@register("pr_curve")
def q_pr_curve(spark, sf_dir):
    c = curves.pr_curve(fx.f_scored2(spark, sf_dir), "click", "click")
    return c.select(F.round("threshold", 6).alias("threshold"), F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"))


@register("roc_corners")
def q_roc_corners(spark, sf_dir):
    c = curves.roc_corners(fx.f_scored2(spark, sf_dir), "click", "click")
    return c.select(F.round("threshold", 6).alias("threshold"), F.round("fpr", 6).alias("fpr"),
                    F.round("tpr", 6).alias("tpr"), "tps", "fps")


@register("pr_curve_closed")
def q_pr_curve_closed(spark, sf_dir):
    c = curves.pr_curve_closed(fx.f_scored2(spark, sf_dir), "click", "click")
    return c.select(F.round("threshold", 6).alias("threshold"), F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"))


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return curves.roc_auc(fx.f_scored2(spark, sf_dir), "click", "click").select(F.round("auc", 6).alias("auc"))


@register("roc_auc_hard")
def q_roc_auc_hard(spark, sf_dir):
    s = fx.f_scored2(spark, sf_dir)
    from .functions.rowwise import argmax_class
    s = s.withColumn("pred", argmax_class(["click", "other"]))
    return curves.roc_auc_hard(metrics.confusion_counts(s), "click").select(
        F.round("auc_hard", 6).alias("auc_hard"))


@register("roc_auc_macro")
def q_roc_auc_macro(spark, sf_dir):
    return curves.roc_auc_macro(fx.f_scored(spark, sf_dir), fx.SCORE_CLASSES).select(
        F.round("auc_macro", 6).alias("auc_macro"))


# ------------------------------------------------------------ prep / balance
def _ord_prepped(spark, sf_dir):
    return prep.prep_columns(fx.f_ord(spark, sf_dir), "row_id", "status")


@register("scan_table")
def q_scan_table(spark, sf_dir):
    return fx.f_ord(spark, sf_dir)


@register("prep_columns")
def q_prep_columns(spark, sf_dir):
    return prep.prep_columns(fx.f_null(spark, sf_dir), "row_id", "status")


@register("with_actual")
def q_with_actual(spark, sf_dir):
    d = fx.f_ord(spark, sf_dir)
    a = prep.with_actual(d, "status").select("row_id", "status_actual")
    b = prep.with_actual(fx.f_extra(spark, sf_dir), "status").select("row_id", "status_actual")
    return a.withColumn("src", F.lit("ord")).unionByName(b.withColumn("src", F.lit("extra")))


@register("drop_columns")
def q_drop_columns(spark, sf_dir):
    return prep.drop_if_present(fx.f_ord(spark, sf_dir), "m", "o_custkey", "not_there")


@register("align_features")
def q_align_features(spark, sf_dir):
    return prep.align_features(fx.f_extra(spark, sf_dir), ["o_totalprice", "o_custkey", "gone"],
                               keep=["row_id"])


@register("tag_literals")
def q_tag_literals(spark, sf_dir):
    return prep.tag(fx.f_ord(spark, sf_dir).select("row_id", "status"),
                    model_name="rf", sampling_type="smote", model_id="m-001")


@register("safe_names")
def q_safe_names(spark, sf_dir):
    return prep.safe_names(fx.f_extra(spark, sf_dir))


@register("target_distribution")
def q_target_distribution(spark, sf_dir):
    vc = balance.value_counts(fx.f_null(spark, sf_dir), "status", dropna=True)
    return vc.select("value", "count", F.round("share", 6).alias("share"), F.round("pct", 4).alias("pct"))


@register("target_distribution_nulls")
def q_target_distribution_nulls(spark, sf_dir):
    vc = balance.value_counts(fx.f_null(spark, sf_dir), "status", dropna=False)
    return vc.select("value", "count", F.round("share", 6).alias("share"), F.round("pct", 4).alias("pct"))


@register("class_list")
def q_class_list(spark, sf_dir):
    return balance.class_list(_ord_prepped(spark, sf_dir))


@register("class_imbalance")
def q_class_imbalance(spark, sf_dir):
    d = prep.prep_columns(fx.f_rare(spark, sf_dir), "row_id", "status")
    return balance.class_imbalance(d)
