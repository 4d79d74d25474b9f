"""End-to-end jobs: Entry A (train, evaluate, score) and Entry B (score with a
stored model).

One lazy lineage per table: read -> prep -> ``split`` and ``fold`` columns ->
cached train frame -> one Spark ML fit per trial x fold (driver thread pool) ->
transform -> aggregates -> keyed writes. Only bounded frames reach the driver:
class lists, trial rows, CV scores, metric rows, bucket tables.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.lists import format_feature_list, parse_feature_list
from ..operators import balance, models, prep, sampling, search, split
from ..session import checkpoint_dir, scratch_path
from ..sources import sinks, tables
from . import buckets, describe, evaluate, metrics


@dataclass
class JobResult:
    best_model: str
    cv: DataFrame
    cv_best: DataFrame
    validation: DataFrame
    report: DataFrame
    breakdown: DataFrame
    precision_buckets: DataFrame | None
    predictions: DataFrame
    extra: dict = field(default_factory=dict)


def train_job(spark: SparkSession, cfg: JobConfig, history: DataFrame, to_score: DataFrame,
              out_root: str, parallelism: int = 4, run_id: str | None = None) -> JobResult:
    """Entry A. ``out_root`` is a shared folder for result tables and models. A job that is
    tried again under its ``run_id`` replaces its own rows of the run log."""
    import time
    marks = [("start", time.time())]
    checkpoint_dir(spark)
    hist = prep.prep_columns(history, cfg.id_col, cfg.target)
    features = prep.feature_columns(hist)
    actual = f"{cfg.target}_actual"
    pred_in = prep.with_actual(to_score, cfg.target)  # the true label stays in the row: no join back
    if cfg.id_col != "id":
        pred_in = pred_in.drop("id").withColumnRenamed(cfg.id_col, "id")
    pred_in = prep.cast_like(prep.align_features(pred_in, features, keep=("id", actual)),
                             hist.drop("target").schema)  # P10: history's types
    focus = cfg.focus_labels()
    if focus is None:  # 'all': every class; the smallest cuts buckets (Q6)
        focus = tuple(sorted(r[0] for r in balance.class_list(hist).select("label").collect()))

    # written once, by split: the folds are ranked from it, and later reads are pruned
    path = scratch_path(spark, "split")
    split.stratified_split(hist, seed=cfg.seed).write.partitionBy("split").parquet(path)
    parts = spark.read.parquet(path)
    val = parts.where(F.col("split") == "validation").drop("split")
    folds = scratch_path(spark, "folds")
    (split.stratified_kfold(parts.where(F.col("split") == "train").drop("split"), cfg.cv_kfold)
     .write.partitionBy("fold").parquet(folds))
    train = spark.read.parquet(folds)
    marks.append(("split_folds", time.time()))

    plan = sampling.sampling_plan(hist, train, preferred=cfg.preferred[1] if cfg.preferred else None)
    models_ = (cfg.preferred[0],) if cfg.preferred else cfg.models
    combos = sampling.model_combos(plan, models_)
    stored = None
    if not cfg.is_update_model_param and sinks.table_at(spark, f"{out_root}/{cfg.registry_table}"):
        reg = spark.read.parquet(f"{out_root}/{cfg.registry_table}").where(F.col("model_ID") == cfg.model_id)
        row = reg.select("model_name", "hyper_parameters").first()
        if row is not None:
            stored = json.loads(row["hyper_parameters"])
            m, s = row["model_name"].split("_", 1)
            combos = spark.createDataFrame([(m, s, 0, row["model_name"])],
                                           "model_name string, sampling_type string, ord int, combo string")
    trials_df = search.hp_trials(combos, cfg.is_gridsearch, cfg.seed, stored_params=stored,
                                 trials=cfg.max_trials)
    trials = [r.asDict() for r in trials_df.collect()]  # bounded: combos x draws
    cv_rows = search.cv_scores(train, trials, cfg.cv_kfold, features, beta=cfg.beta,
                               accuracy=cfg.accuracy_focus == "accuracy", parallelism=parallelism,
                               seed=cfg.seed)
    marks.append(("plan_trials_cv", time.time()))
    cv = spark.createDataFrame(cv_rows, search.CV_SCHEMA)
    best = search.best_per_combo(search.cv_summary(cv)).cache()
    if cfg.cv_score_table:
        sinks.persist_data(best.withColumn("model_id", F.lit(cfg.model_id)),
                           f"{out_root}/{cfg.cv_score_table}", ["model_id", "model_name", "sampling_type"],
                           partition_by="model_id")
    best_model = search.best_combo(best).first()["best_model"]

    fitted, preds = {}, {}
    best_rows = best.collect()  # one row per combo
    for s in sorted({r["sampling_type"] for r in best_rows}):  # one prepared frame per sampling
        prepared = models.prepare(train.drop("fold"), features, s, cfg.seed)
        for r in (x for x in best_rows if x["sampling_type"] == s):
            combo = f"{r['model_name']}_{s}"
            fm = models.fit_prepared(prepared, r["model_name"], json.loads(r["hyper_parameters"]), cfg.seed)
            fitted[combo] = fm
            preds[combo] = models.predict(fm, val, keep=("id", "target")).cache()
        prepared.release()
    marks.append(("best_refit", time.time()))
    validation = search.leaderboard(metrics.validation_table(preds, focus, cfg.beta), cfg.accuracy_focus)

    if cfg.is_update_model_param:
        reg_row = (validation.where(F.col("model_name") == best_model)
                   .join(best.select(F.concat_ws("_", "model_name", "sampling_type").alias("model_name"),
                                     "hyper_parameters"), "model_name")
                   .select(F.lit(cfg.model_id).alias("model_ID"), "model_name", "hyper_parameters",
                           F.lit(cfg.historic_table).alias("historic_table_name"),
                           F.lit(cfg.prediction_table).alias("prediction_table_name"),
                           F.lit(cfg.is_gridsearch).alias("is_gridsearch"), F.lit(cfg.target).alias("target_name"),
                           F.lit(json.dumps(list(cfg.target_focus))).alias("target_focus"),
                           F.lit(cfg.preferred_model).alias("preferred_model"),
                           "recall", "precision", "f1", "f_beta", "overall_recall", "overall_precision",
                           "overall_f1", "overall_fbeta", "accuracy",
                           F.date_format(F.current_timestamp(), "dd/MM/yyyy HH:mm:ss").alias("inserted_at")))
        sinks.replace_by_key(reg_row, f"{out_root}/{cfg.registry_table}", "model_ID")

    vbest = preds[best_model].withColumnRenamed("target", "actual")
    report = metrics.classification_report(metrics.confusion_counts(vbest))
    breakdown = buckets.percentile_breakdown(vbest, focus).withColumn("model_id", F.lit(cfg.model_id))
    if cfg.cl_report_table:
        sinks.persist_data(breakdown, f"{out_root}/{cfg.cl_report_table}", ["model_id", "value"],
                           partition_by="model_id")
    pbuckets = None
    if cfg.focus_labels() is not None:
        pbuckets = buckets.precision_buckets(vbest, focus)
        if cfg.precision_buckets_table:
            sinks.persist_data(pbuckets.select("percentile", "precision", "percentile_value", "users")
                               .withColumn("model_id", F.lit(cfg.model_id)),
                               f"{out_root}/{cfg.precision_buckets_table}", ["model_id"],
                               partition_by="model_id")

    fm = fitted[best_model]
    sets = {"train": models.predict(fm, train, keep=("id", "target")).withColumnRenamed("target", "actual"),
            "validation": vbest}
    if cfg.target in to_score.columns:
        sets["test"] = models.predict(fm, pred_in, keep=("id", actual)).withColumnRenamed(actual, "actual")
    frames = {"train": train, "validation": val, "test": pred_in}
    tables_ = evaluate.evaluate(sets, fm.labels, focus, cfg.beta)
    tables_["breakdown_allpos"] = buckets.percentile_breakdown(vbest, focus, all_positive=True)  # E8
    tables_["describe"] = describe.describe(evaluate.tagged({k: v.select(*[F.col(f"`{c}`") for c in features])
                                                             for k, v in frames.items()}), features, by="set")
    importance = models.feature_importance(fm)  # one number per feature
    if importance:
        tables_["importance"] = spark.createDataFrame(importance, "variable_name string, importance double")
    evaluation = {name: sinks.replace_by_key(t.withColumn("model_id", F.lit(cfg.model_id)),
                                             f"{out_root}/evaluation_{name}", "model_id", [cfg.model_id])
                  .where(F.col("model_id") == cfg.model_id) for name, t in tables_.items()}
    for name in ("report", "describe"):  # S8
        sinks.export_csv(evaluation[name], f"{out_root}/export/{cfg.model_id}_{name}")
    settings = {f.name: getattr(cfg, f.name) for f in fields(cfg)} | {"best_model": best_model, **fm.params}
    params = spark.createDataFrame([(k, json.dumps(v, default=str)) for k, v in settings.items()], "name string, value string")
    dist = evaluation["distribution"].select(F.concat_ws(" ", "set", "label").alias("name"), F.col("count").alias("value"))
    sinks.log_kinds({"param": params, "distribution": dist,
                     "metric": evaluation["metrics"].select(F.col("Metric").alias("name"), F.col("Value").alias("value"))},
                    f"{out_root}/run_log", run_id or uuid.uuid4().hex, cfg.model_id, best_model)  # S9
    marks.append(("registry_reports", time.time()))
    scored = models.predict(fm, pred_in, keep=("id", *features, actual), with_probability=cfg.show_probability)
    out = prep.tag(prep.safe_names(scored.withColumnRenamed("pred", cfg.target)), model_id=cfg.model_id)
    if cfg.persist_model:
        models.save_model(fm, cfg.model_location or f"{out_root}/models", cfg.model_id)
        top = spark.createDataFrame([(cfg.model_id, features)], "model_id string, features array<string>")
        sinks.persist_data(top.select("model_id", format_feature_list(F.col("features")).alias("list"),
                                      F.current_timestamp().alias("inserted_at")),
                           f"{out_root}/{cfg.top_vars_table}", ["model_id"], partition_by="model_id")
    # the model's predictions are replaced as a whole: no rows of an earlier table stay
    results = sinks.replace_by_key(out, f"{out_root}/{cfg.prediction_table}_results", "model_id", [cfg.model_id])
    results = results.where(F.col("model_id") == cfg.model_id)
    for p in preds.values():
        p.unpersist()
    best.unpersist()
    marks.append(("score_persist", time.time()))
    phases = {marks[i][0]: round(marks[i][1] - marks[i - 1][1], 3) for i in range(1, len(marks))}
    return JobResult(best_model, cv, best, validation, report, breakdown, pbuckets, results,
                     extra={"fitted": fitted, "phase_sec": phases, "evaluation": evaluation})


def score_with_stored_model(spark: SparkSession, to_score: DataFrame, model_root: str, model_id: str,
                            id_col: str, target: str, top_vars: DataFrame | None = None,
                            show_probability: bool = True) -> DataFrame:
    """Entry B (T15): stored model + stored feature list -> aligned features
    (absent ones 0, Q11) -> id, features, prediction, class probabilities, actual
    label, model id. Features and label travel through the prediction: a narrow
    plan over the prediction table, without a join."""
    fm = models.load_model(spark, model_root, model_id)
    feats = fm.features
    if top_vars is not None:
        row = top_vars.where(F.col("model_id") == model_id).select(parse_feature_list(F.col("list")).alias("l")).first()
        if row is not None:
            feats = list(row["l"])
    d = prep.with_actual(to_score, target)
    actual = f"{target}_actual"
    x = d.drop("id").withColumnRenamed(id_col, "id") if id_col != "id" else d
    x = prep.align_features(x, feats, keep=("id", actual))
    fm.features = feats
    p = models.predict(fm, x, keep=("id", *feats, actual), with_probability=show_probability)
    return prep.tag(prep.safe_names(p.withColumnRenamed("pred", target)), model_id=model_id)


def run(spark: SparkSession, cfg: JobConfig, out_root: str, sf_dir: str | None = None):
    """The job a configuration describes: reads its tables and trains, evaluates
    and scores (Entry A), or scores with the stored model (Entry B) when
    ``read_model`` is set. Returns the predictions of its model id."""
    to_score = tables.read_table(spark, cfg.prediction_table, sf_dir)
    if not cfg.read_model:
        history = tables.read_table(spark, cfg.historic_table, sf_dir)
        return train_job(spark, cfg, history, to_score, out_root).predictions
    top = None
    if sinks.table_at(spark, f"{out_root}/{cfg.top_vars_table}"):
        top = spark.read.parquet(f"{out_root}/{cfg.top_vars_table}")
    out = score_with_stored_model(spark, to_score, cfg.model_location or f"{out_root}/models", cfg.model_id,
                                  cfg.id_col, cfg.target, top, cfg.show_probability)
    res = sinks.replace_by_key(out, f"{out_root}/{cfg.prediction_table}_results", "model_id", [cfg.model_id])
    return res.where(F.col("model_id") == cfg.model_id)
