"""Registered queries, third part: learners, cross-validation, search results,
leaderboard, registry row, scoring and the model store.

Gaussian naive Bayes is deterministic and expressible in SQL, so the search
bookkeeping (CV scores, their summary, best trial per combo, best combo,
leaderboard, registry row) is checked against DuckDB on NB fits over F_SEP.
Tree learners must reproduce the step function of F_STEP; boosting's losses are
checked against boosting written in SQL.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .operators import models, prep, search, split
from .plans import metrics
from .queries import register
from .session import staged
from .sources import fixtures as fx
from .sources import sinks, tables

SEP_FEATURES = ("value", "hr", "user_id")
SEP_FOCUS = ("high", "low")
SEP_BETA = 2.0            # accuracy focus 'recall'
CV_K = 3
NB_SAMPLINGS = ("NA", "us", "os")
BOOST = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "gamma": 0.05, "reg_alpha": 0.1, "reg_lambda": 2,
         "min_child_weight": 3}


def _sep(spark, sf_dir):
    d = prep.prep_columns(fx.f_sep(spark, sf_dir), "event_id", "band")
    return staged(split.stratified_split(d), "sep")  # reused by every fit: computed once, read by column


def _sep_parts(spark, sf_dir):
    s = _sep(spark, sf_dir)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "validation").drop("split")


@register("fit_nb")
def q_fit_nb(spark, sf_dir):
    train, val = _sep_parts(spark, sf_dir)
    fm = models.fit_model(train, SEP_FEATURES, "nb")
    return models.predict(fm, val, with_probability=False)


def _nb_cv(spark, sf_dir):
    train, _ = _sep_parts(spark, sf_dir)
    train = split.stratified_kfold(train, CV_K).cache()
    trials = [{"replication_id": i + 1, "model_name": "nb", "sampling_type": s, "hyper_parameters": "{}"}
              for i, s in enumerate(NB_SAMPLINGS)]

    rows = search.cv_scores(train, trials, CV_K, SEP_FEATURES, beta=1.0, parallelism=3)
    train.unpersist()
    return spark.createDataFrame(rows, search.CV_SCHEMA)  # trials x folds rows


@register("cv_scores")
def q_cv_scores(spark, sf_dir):
    cv = _nb_cv(spark, sf_dir)
    return cv.withColumn("cv_score", F.round("cv_score", 6))


def _summary(spark, sf_dir):
    return search.cv_summary(_nb_cv(spark, sf_dir))


@register("cv_summary")
def q_cv_summary(spark, sf_dir):
    s = _summary(spark, sf_dir)
    return s.select("replication_id", "model_name", "sampling_type", "hyper_parameters",
                    F.round("cv_score_mean", 6).alias("cv_score_mean"),
                    F.round("cv_score_std", 6).alias("cv_score_std"))


@register("best_per_combo")
def q_best_per_combo(spark, sf_dir):
    b = search.best_per_combo(_summary(spark, sf_dir))
    return b.select("model_name", "sampling_type", "replication_id",
                    F.round("cv_score_mean", 6).alias("cv_score_mean"))


@register("best_combo")
def q_best_combo(spark, sf_dir):
    b = search.best_combo(search.best_per_combo(_summary(spark, sf_dir)))
    return b.select("best_model", F.round("cv_score_mean", 6).alias("cv_score_mean"))


def _nb_leaderboard(spark, sf_dir):
    train, val = _sep_parts(spark, sf_dir)
    preds = {}
    for s in NB_SAMPLINGS:
        fm = models.fit_model(train, SEP_FEATURES, "nb", s)
        preds[f"nb_{s}"] = models.predict(fm, val, keep=("id", "target"), with_probability=False)
    return metrics.validation_table(preds, SEP_FOCUS, SEP_BETA)


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    v = _nb_leaderboard(spark, sf_dir)
    return search.leaderboard(v.select("model_name", *[F.round(c, 4).alias(c) for c in v.columns
                                                      if c != "model_name"]), "recall")


@register("registry_row")
def q_registry_row(spark, sf_dir):
    """Best combo by CV + its validation metrics + the job settings."""
    best = search.best_combo(search.best_per_combo(_summary(spark, sf_dir)))
    lb = _nb_leaderboard(spark, sf_dir)
    row = best.join(lb, best["best_model"] == lb["model_name"]).drop("best_model", "cv_score_mean")
    return row.select(
        F.lit("m-sep-01").alias("model_ID"), "model_name", F.lit("{}").alias("hyper_parameters"),
        F.lit("events").alias("historic_table_name"), F.lit("events").alias("prediction_table_name"),
        F.lit(False).alias("is_gridsearch"), F.lit("band").alias("target_name"),
        F.lit(json.dumps(list(SEP_FOCUS))).alias("target_focus"), F.lit("").alias("preferred_model"),
        *[F.round(c, 4).alias(c) for c in ("recall", "precision", "f1", "f_beta", "overall_recall",
                                            "overall_precision", "overall_f1", "overall_fbeta", "accuracy")])


# ------------------------------------------------------------------ learners
STEP_FEATURES = ("hr", "noise")


def _step_parts(spark, sf_dir):
    from .session import scratch_path
    path = scratch_path(spark, "step")
    split.stratified_split(prep.prep_columns(fx.f_step(spark, sf_dir), "event_id", "part")).write.parquet(path)
    s = spark.read.parquet(path)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "validation").drop("split")


def _fit_and_score(spark, sf_dir, model_name, params=None):
    train, val = _sep_parts(spark, sf_dir)
    fm = models.fit_model(train, SEP_FEATURES, model_name, "NA", params)
    return models.predict(fm, val, keep=("id",))


def _fit_step(spark, sf_dir, model_name, params):
    """id, prediction and the sum of the class probabilities on F_STEP."""
    train, val = _step_parts(spark, sf_dir)
    fm = models.fit_model(train, STEP_FEATURES, model_name, "NA", params)
    p = models.predict(fm, val, keep=("id",))
    return p.select("id", "pred", F.round(sum(F.col(f"`{c}`") for c in fm.labels), 6).alias("prob_sum"))


@register("fit_rf")
def q_fit_rf(spark, sf_dir):
    return _fit_step(spark, sf_dir, "rf", {"n_estimators": 100, "max_depth": 8, "max_features": "sqrt",
                                           "criterion": "gini", "min_samples_leaf": 5})


@register("fit_dt")
def q_fit_dt(spark, sf_dir):
    return _fit_step(spark, sf_dir, "dt", {"max_depth": 5})


@register("fit_gbt")
def q_fit_gbt(spark, sf_dir):
    return _fit_step(spark, sf_dir, "xg", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1})


@register("score")
def q_score(spark, sf_dir):
    """T12 with Gaussian NB: prediction and one probability column per class."""
    p = _fit_and_score(spark, sf_dir, "nb")
    return p.select("id", "pred", *[F.round(c, 6).alias(c) for c in ("high", "low", "mid")])


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """T10 on F_STEP: rank of each feature (the label depends on ``hr`` alone)."""
    train, _ = _step_parts(spark, sf_dir)
    fm = models.fit_model(train, STEP_FEATURES, "rf", "NA", {"n_estimators": 100, "max_depth": 5})
    imp = models.feature_importance(fm)  # one number per feature, largest first
    rows = [(name, i + 1, share > 0.5) for i, (name, share) in enumerate(imp)]
    return spark.createDataFrame(rows, "variable_name string, importance_rank int, leads boolean")


@register("loss_curve")
def q_loss_curve(spark, sf_dir):
    """Multi-class log-loss by number of rounds on train and validation (two
    classes on F_RARE, three on F_STEP)."""
    rare = fx.f_rare(spark, sf_dir).select("row_id", "m", (F.col("o_custkey") % 7).alias("c"), "status")
    d = split.stratified_split(prep.prep_columns(rare, "row_id", "status"))
    parts = tuple(d.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    out = None
    for name, (train, val), feats in (("rare", parts, ("m", "c")), ("step", _step_parts(spark, sf_dir), STEP_FEATURES)):
        fm = models.fit_model(train, feats, "xg", "NA", BOOST)
        t = models.loss_curve(fm, {"train": train, "validation": val}).groupBy("n_trees").agg(
            *[F.round(F.max(F.when(F.col("set") == s, F.col("loss"))), 6).alias(f"{s}_loss") for s in ("train", "validation")])
        t = t.withColumn("fixture", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


@register("fit_xg")
def q_fit_xg(spark, sf_dir):
    """T6 with every parameter of the search space set, on F_STEP."""
    return _fit_step(spark, sf_dir, "xg", {"learning_rate": 0.01, "n_estimators": 100, "max_depth": 3, "gamma": 0.1,
                                           "colsample_bytree": 0.7, "subsample": 0.7, "reg_alpha": 0.1,
                                           "reg_lambda": 1, "min_child_weight": 3})


@register("cross_validator")
def q_cross_validator(spark, sf_dir):
    """T2 / T3 as Spark ML classes: ``CrossValidator`` over the samplings on the fold column."""
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from .operators.estimators import MacroFBetaEvaluator, ResampledClassifier
    train, _ = _sep_parts(spark, sf_dir)
    train = split.stratified_kfold(train, CV_K).withColumn("fold", F.col("fold").cast("int")).cache()
    est = ResampledClassifier(modelName="nb", features=list(SEP_FEATURES))
    grid = ParamGridBuilder().addGrid(est.samplingType, list(NB_SAMPLINGS)).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=MacroFBetaEvaluator(), numFolds=CV_K,
                        foldCol="fold", parallelism=3).fit(train)
    train.unpersist()
    rows = [(i + 1, s, round(float(m), 6)) for i, (s, m) in enumerate(zip(NB_SAMPLINGS, cv.avgMetrics, strict=True))]
    return spark.createDataFrame(rows, "replication_id int, sampling_type string, cv_score_mean double")  # a row a sampling


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    from .session import scratch_path
    train, val = _step_parts(spark, sf_dir)
    fm = models.fit_model(train, STEP_FEATURES, "dt", "NA", {"max_depth": 4})
    root = scratch_path(spark, "models")
    models.save_model(fm, root, "m-rt")
    back = models.load_model(spark, root, "m-rt")
    a = models.predict(fm, val, with_probability=False).withColumnRenamed("pred", "pred_fitted")
    b = models.predict(back, val, with_probability=False).withColumnRenamed("pred", "pred_loaded")
    return a.join(b, "id").withColumn("same", F.col("pred_fitted") == F.col("pred_loaded"))


@register("score_stored")
def q_score_stored(spark, sf_dir):
    """T15 (Entry B): stored model + stored feature list -> aligned, scored,
    joined to actuals, names made safe, tagged; the prediction table is the
    whole events table."""
    from .plans.job import score_with_stored_model
    from .session import scratch_path
    train, _ = _sep_parts(spark, sf_dir)
    fm = models.fit_model(train, SEP_FEATURES, "nb", "NA")
    root = scratch_path(spark, "models")
    models.save_model(fm, root, "m-sep-01")
    events = tables.read_table(spark, "events", sf_dir)
    pred_table = fx.f_sep(spark, sf_dir).join(events.select("event_id", "props"), "event_id")
    out = score_with_stored_model(spark, pred_table, root, "m-sep-01", id_col="event_id", target="band")
    return out.select("id", *SEP_FEATURES, "band", *[F.round(c, 6).alias(c) for c in ("high", "low", "mid")],
                      "band_actual", "model_id")


@register("best_params")
def q_best_params(spark, sf_dir):
    """F2: parameters and mean score of one (model, sampling) from the CV table."""
    s = _summary(spark, sf_dir)
    hit = s.where((F.col("model_name") == "nb") & (F.col("sampling_type") == "us"))
    return hit.select("hyper_parameters", F.round("cv_score_mean", 6).alias("cv_score_mean"))


@register("train_and_score")
def q_train_and_score(spark, sf_dir):
    """Entry A end to end on F_STEP: search (dt, and rf with 2 of its 20 draws;
    3 folds), refit, registry, reports, scoring of the whole table, keyed write."""
    from .config import JobConfig
    from .plans.job import train_job
    from .session import scratch_path
    step = fx.f_step(spark, sf_dir)
    cfg = JobConfig(historic_table="events", prediction_table="events_scored", target="part",
                    id_col="event_id", model_id="m-step-01", accuracy_focus="recall",
                    target_focus=("night", "day"), models=("dt", "rf"), cv_kfold=CV_K, max_trials={"rf": 2})
    res = train_job(spark, cfg, step, step, scratch_path(spark, "job"))
    return res.predictions.select("id", "hr", "noise", "part", "part_actual", "model_id")


def _nb_job(spark, sf_dir):
    """Entry A with one combo (NB without re-sampling) on F_SEP; (result, folder)."""
    from .config import JobConfig
    from .plans.job import train_job
    from .session import scratch_path
    sep, root = fx.f_sep(spark, sf_dir), scratch_path(spark, "job")
    cfg = JobConfig(historic_table="events", prediction_table="events_scored", target="band", id_col="event_id",
                    model_id="m-sep-02", accuracy_focus="recall", target_focus=SEP_FOCUS, preferred_model="nb_NA",
                    cv_kfold=CV_K)
    return train_job(spark, cfg, sep, sep, root), root


@register("job_report")
def q_job_report(spark, sf_dir):
    """E6 from the job's own evaluation table: validation and test reports."""
    res, _ = _nb_job(spark, sf_dir)
    r = res.extra["evaluation"]["report"].where(F.col("set") != "train")
    return r.select("set", "value", "precision", "recall", "f1_score", "support")


@register("job_run_log")
def q_job_run_log(spark, sf_dir):
    """S9 as the job writes it: the test metrics, and how many rows per set."""
    _, root = _nb_job(spark, sf_dir)
    log = sinks.read_log(spark, f"{root}/run_log").where(F.col("kind") == "metric")
    v = F.when(F.col("name").isin("test_overall_recall", "test_accuracy"), F.col("value").cast("double"))
    return log.groupBy(F.split("name", "_")[0].alias("set")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max(v), 3).alias("best"))


@register("rescore_replaces")
def q_rescore_replaces(spark, sf_dir):
    """The whole table is scored with the stored model, then only its
    even ids; none of the first rows may stay."""
    from .config import JobConfig
    from .plans import job
    from .session import scratch_path
    train, _ = _sep_parts(spark, sf_dir)
    root = scratch_path(spark, "rescore")
    models.save_model(models.fit_model(train, SEP_FEATURES, "nb", "NA"), f"{root}/models", "m-sep-03")
    cfg = JobConfig(historic_table="", prediction_table="sep", target="band", id_col="event_id", model_id="m-sep-03",
                    read_model=True)
    data = scratch_path(spark, "rescore-in")
    for n, d in enumerate((fx.f_sep(spark, sf_dir), fx.f_sep(spark, sf_dir).where(F.col("event_id") % 2 == 0))):
        d.write.parquet(f"{data}/{n}/sep.parquet")
        out = job.run(spark, cfg, root, f"{data}/{n}")
    return out.select("id", "value", "band", "band_actual", "model_id")


@register("ovr_os")
def q_ovr_os(spark, sf_dir):
    """T8 with over-sampling: 3-NN votes on re-sampled rows (ids repeat)."""
    train, val = _sep_parts(spark, sf_dir)
    fm = models.fit_model(train, ("hr", "user_id"), "ovr", "os")
    p = models.predict(fm, val, keep=("id",))
    return p.select("id", "pred", *[F.round(c, 6).alias(c) for c in ("high", "low", "mid")])


@register("smote_nulls")
def q_smote_nulls(spark, sf_dir):
    """M5 after M9: classes are level although the features had nulls."""
    d = prep.prep_columns(fx.f_null(spark, sf_dir).where("status is not null"), "row_id", "status")
    p = models.prepare(d, ("o_totalprice", "o_custkey", "m"), "smote", cache=False)
    return p.frame.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@register("job_auc_hard")
def q_job_auc_hard(spark, sf_dir):
    """E11b from the job's own evaluation tables: validation and test."""
    res, _ = _nb_job(spark, sf_dir)
    t = res.extra["evaluation"]["auc_hard"].where(F.col("set") != "train")
    return t.select("set", F.round("auc_hard", 6).alias("auc_hard"))


@register("job_allpos")
def q_job_allpos(spark, sf_dir):
    """E8 from the job's own evaluation tables: a tree on F_STEP, whose scores are 0 and 1."""
    from .config import JobConfig
    from .plans.job import train_job
    from .session import scratch_path
    step = fx.f_step(spark, sf_dir)
    cfg = JobConfig(historic_table="events", prediction_table="events_scored", target="part", id_col="event_id",
                    model_id="m-step-02", accuracy_focus="recall", target_focus=("night", "day"), preferred_model="dt_NA",
                    cv_kfold=CV_K)
    t = train_job(spark, cfg, step, step, scratch_path(spark, "job")).extra["evaluation"]["breakdown_allpos"]
    return t.select("value", "precision", "recall", "f1_score", "support", "percentile")


@register("job_run_kinds")
def q_job_run_kinds(spark, sf_dir):
    """Some parameters, the target distributions and the number of metrics in the log of a job
    that was run twice under one run id."""
    from .config import JobConfig
    from .plans.job import train_job
    from .session import scratch_path
    sep, root = fx.f_sep(spark, sf_dir), scratch_path(spark, "job")
    cfg = JobConfig(historic_table="events", prediction_table="events_scored", target="band", id_col="event_id",
                    model_id="m-sep-04", accuracy_focus="recall", target_focus=SEP_FOCUS, preferred_model="nb_NA",
                    cv_kfold=CV_K)
    for _ in range(2):
        train_job(spark, cfg, sep, sep, root, run_id="run-7")
    log = sinks.read_log(spark, f"{root}/run_log")
    some = log.where("kind = 'param' AND name IN ('model_id', 'best_model', 'cv_kfold', 'target') OR kind = 'distribution' "
                     "AND name LIKE 'test actual %'").select("run_id", "kind", "name", "value")
    n = log.where("kind = 'metric'").groupBy("run_id").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        "run_id", F.lit("metric").alias("kind"), F.lit("rows").alias("name"), "value")
    return some.unionByName(n)


@register("replace_key_by_nothing")
def q_replace_key_by_nothing(spark, sf_dir):
    """One model's rows are replaced by an empty table; the others stay."""
    from .session import scratch_path
    path = scratch_path(spark, "emptied")
    first = fx.f_ord(spark, sf_dir).select("row_id", "o_totalprice", F.col("status").alias("model_id"))
    sinks.replace_by_key(first, path, "model_id")
    return sinks.replace_by_key(first.where("false"), path, "model_id", ["F"]).select("row_id", "o_totalprice", "model_id")


@register("snapshot_replace")
def q_snapshot_replace(spark, sf_dir):
    """S6 / S7 in versions: one model's rows replaced, one model's replaced by nothing; the last version."""
    from .session import scratch_path
    from .sources import snapshots
    path = scratch_path(spark, "versions")
    first = fx.f_ord(spark, sf_dir).select("row_id", "o_totalprice", F.col("status").alias("model_id"))
    snapshots.commit(first, path, "model_id")
    snapshots.commit(first.where("model_id = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, "model_id")
    return snapshots.commit(first.where("false"), path, "model_id", ["F"])


@register("ensemble_models")
def q_ensemble_models(spark, sf_dir):
    """T16 over three fitted combos in one scan: largest encoded prediction, mean probabilities."""
    train, val = _sep_parts(spark, sf_dir)
    fitted = {f"nb_{s}": models.fit_model(train, SEP_FEATURES, "nb", s) for s in NB_SAMPLINGS}
    e = models.ensemble(fitted, val)
    return e.select("id", "ens_pred", *[F.round(c, 6).alias(c) for c in ("high", "low", "mid")])


@register("grouped_linear")
def q_grouped_linear(spark, sf_dir):
    """G1: a user's linear model per event type; groups above 500 rows are fitted in shards
    and merged from their sums."""
    import pandas as pd

    from .operators.grouped import map_groups
    d = fx.f_sep(spark, sf_dir).join(tables.read_table(spark, "events", sf_dir).select("event_id", "event_type"), "event_id")
    names = ["n", "sx", "sy", "sxx", "sxy"]

    def fit(pdf):
        x, y = pdf["hr"].astype(float), pdf["value"]
        return pd.DataFrame([[pdf["event_type"].iloc[0], float(len(x)), x.sum(), y.sum(), (x * x).sum(), (x * y).sum()]],
                            columns=["event_type", *names])

    def merge(pdf):
        n, sx, sy, sxx, sxy = (pdf[c].sum() for c in names)
        slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
        return pd.DataFrame([[pdf["event_type"].iloc[0], int(n), slope, (sy - slope * sx) / n]],
                            columns=["event_type", "n_rows", "slope", "intercept"])

    out = map_groups(d, "event_type", fit, "event_type string, " + ", ".join(f"{c} double" for c in names), merge,
                     "event_type string, n_rows long, slope double, intercept double", max_rows=500)
    return out.select("event_type", "n_rows", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@register("smote_lsh")
def q_smote_lsh(spark, sf_dir):
    """M5 with approximate neighbours on F_RARE: classes are level, and every new row's neighbour
    is another row of its class."""
    from .operators.smote import smote
    d = prep.prep_columns(fx.f_rare(spark, sf_dir), "row_id", "status")
    s = smote(d, ("o_totalprice", "o_custkey", "m"), neighbours="lsh")
    same = s.join(d.select(F.col("id").alias("nb_id"), F.col("target").alias("nt")), "nb_id", "left")
    wrong = F.col("synthetic") & ((F.col("nt").isNull()) | (F.col("nt") != F.col("target")) | (F.col("nb_id") == F.col("id")))
    return same.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("synthetic")).alias("n_new"),
                                      F.count_if(wrong).alias("n_wrong"))
