"""Hyper-parameter search bookkeeping (T1, J1, A4, W3, W4) and the CV loop.

Trials are rows: (replication_id, model_name, sampling_type, hyper_parameters
JSON). Draws are seeded hash picks from the fixed value lists, so a trial is
known before anything is fitted and a retried task draws the same values.
The training data is never copied per trial: the CV loop fits on the one
cached train frame filtered by its ``fold`` column.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TRIALS_GRID
from ..functions.hashing import hash32

# The random-search spaces (JSON text of each allowed value, in
# the key order of the stored parameter JSON).
RF_SPACE = (
    ("n_estimators", tuple(str(i) for i in range(100, 401))),
    ("max_depth", tuple(str(i) for i in range(2, 12))),
    ("min_samples_leaf", tuple(str(i) for i in range(5, 15))),
    ("min_samples_split", tuple(str(i) for i in range(5, 15))),
    ("max_features", ('"log2"', '"sqrt"')),
    ("criterion", ('"gini"', '"entropy"')),
)
XG_SPACE = (
    ("learning_rate", ("0.001", "0.01")),
    ("n_estimators", ("100", "300", "500")),
    ("max_depth", ("3", "5", "7")),
    ("gamma", ("0", "0.01", "0.05", "0.1", "0.2", "0.3")),
    ("colsample_bytree", ("0.3", "0.5", "0.7")),
    ("reg_alpha", ("0", "0.01", "0.1", "0.5")),
    ("reg_lambda", ("0.1", "1", "5", "10", "100")),
    ("min_child_weight", ("1", "3", "5", "10", "15")),
    ("subsample", ("0.5", "0.7")),
)
SPACES = {"rf": RF_SPACE, "xg": XG_SPACE}

BOOSTED = 40  # parameter sets grown together: their margins are a row's state
CV_SCHEMA = ("replication_id int, model_name string, sampling_type string, "
             "cv_score double, hyper_parameters string")


def _draw_json(model: str, seed, rep: Column) -> Column:
    space = SPACES[model]
    parts = []
    for i, (name, values) in enumerate(space):
        arr = F.array(*[F.lit(v) for v in values])
        idx = (hash32(seed, rep, name) % F.lit(len(values)) + 1).cast("int")
        parts += [F.lit(("{" if i == 0 else ", ") + json.dumps(name) + ": "), F.element_at(arr, idx)]
    return F.concat(*parts, F.lit("}"))


def hp_trials(combos: DataFrame, is_gridsearch: bool = True, seed=1,
              stored_params: dict | None = None, trials: dict | None = None) -> DataFrame:
    """Trial rows for each combo, replication ids running over the combos
    in their ``ord`` order. With grid search: 40 draws for 'xg', 20 for 'rf',
    1 otherwise; without: one trial with the stored parameters (or ``{}``).
    Stored parameters, also an empty set, win over new draws (Q17)."""
    trials = dict(TRIALS_GRID if trials is None else trials)
    rows = combos.select("model_name", "sampling_type", "ord").orderBy("ord").collect()  # a few combos
    plan, start = [], 1
    for r in rows:
        n = trials.get(r["model_name"], 1) if (is_gridsearch and stored_params is None) else 1
        plan.append((r["model_name"], r["sampling_type"], start, n))
        start += n
    spark = combos.sparkSession
    t = spark.createDataFrame(plan, "model_name string, sampling_type string, start int, n int")
    t = t.select("model_name", "sampling_type",
                 F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("replication_id"))
    fixed = F.lit(json.dumps(stored_params or {}))
    hp = fixed
    if is_gridsearch and stored_params is None:
        hp = F.when(F.col("model_name") == "xg", _draw_json("xg", seed, F.col("replication_id"))) \
              .when(F.col("model_name") == "rf", _draw_json("rf", seed, F.col("replication_id"))) \
              .otherwise(fixed)
    return t.select("replication_id", "model_name", "sampling_type", hp.alias("hyper_parameters"))


def trial_grid(trials: DataFrame, k: int) -> DataFrame:
    """Every trial x fold (one row per fold fit) — a per-row explode of the
    small trial table, not a copy of the training data."""
    return trials.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def cv_summary(cv: DataFrame) -> DataFrame:
    """A4: mean and sample std of the fold scores per trial."""
    return (cv.groupBy("replication_id", "model_name", "sampling_type", "hyper_parameters")
            .agg(F.avg("cv_score").alias("cv_score_mean"), F.stddev_samp("cv_score").alias("cv_score_std")))


def best_per_combo(summary: DataFrame) -> DataFrame:
    """Best trial per (model, sampling) by mean score; ties -> lowest
    replication id. A max over a struct: plain partial aggregation."""
    key = F.struct(F.col("cv_score_mean"), (-F.col("replication_id")).alias("nr"))
    payload = F.struct(*[F.col(c) for c in summary.columns if c not in ("model_name", "sampling_type")])
    best = summary.groupBy("model_name", "sampling_type").agg(F.max_by(payload, key).alias("b"))
    return best.select("model_name", "sampling_type", "b.*")


def best_combo(best: DataFrame) -> DataFrame:
    """The overall best combo as '<model>_<sampling>' (top-1 is the feature)."""
    key = F.struct(F.col("cv_score_mean"), (-F.col("replication_id")).alias("nr"))
    return best.agg(F.max_by(F.struct("model_name", "sampling_type", "cv_score_mean"), key).alias("b")) \
        .select(F.concat_ws("_", "b.model_name", "b.sampling_type").alias("best_model"),
                F.col("b.cv_score_mean").alias("cv_score_mean"))


def leaderboard(validation: DataFrame, accuracy_focus: str) -> DataFrame:
    """Per-combo validation table sorted by accuracy or F-beta (descending)."""
    key = "accuracy" if accuracy_focus == "accuracy" else "f_beta"
    return validation.orderBy(F.desc(key), "model_name")


def cv_scores(train: DataFrame, trials: Sequence[dict], k: int, features: Sequence[str],
              beta: float = 1.0, accuracy: bool = False, fold_col: str = "fold",
              parallelism: int = 4, seed: int = 1) -> list[tuple]:
    """K-fold CV of every trial; one row per (trial, fold) in ``CV_SCHEMA``.

    Per fold, one sampling after the other: its training part is resampled
    (over-sampling as weights), prepared and cached once
    (:func:`models.prepare`), and the held-out fold is transformed once for all samplings; the
    trials then fit only their classifier: boosted ones all together, the others
    from a driver thread pool (each fit is a distributed Spark ML job). The sampler
    never sees the held-out fold. Scores come from the collected confusion
    counts (classes^2 rows).
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml import PipelineModel

    from ..plans.metrics import score_from_counts
    from . import models

    feats = list(features)
    by_sampling: dict[str, list[dict]] = {}
    for t in trials:
        by_sampling.setdefault(t["sampling_type"], []).append(t)
    out: list[tuple] = []

    def score(fm, held, held_rows, labels) -> float:
        if fm.model_name == "ovr":
            pr = models.predict(fm, held_rows, keep=("id", "target"), with_probability=False)
            rows = [tuple(r) for r in pr.groupBy("target", "pred").count().collect()]
        else:
            cm = fm.pipeline.stages[-1].transform(held).groupBy("target", "prediction").count().collect()
            rows = [(r[0], labels[int(r[1])] if int(r[1]) < len(labels) else "<unknown>", r[2]) for r in cm]
        return float(score_from_counts(rows, beta, accuracy))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        for f in range(k):
            fit_part, held_rows = train.where(F.col(fold_col) != f), train.where(F.col(fold_col) == f)
            raw = held_rows.select("id", *models._raw(feats), "target")
            stages = models.fit_stages(fit_part, feats)  # once a fold, whatever the samplings
            held = PipelineModel(stages=stages).transform(raw).select("features", "target").persist()
            for sampling, ts in by_sampling.items():
                p = models.prepare(fit_part, feats, sampling, seed, stages=stages)

                def run(batch, p=p, held=held, held_rows=held_rows):
                    name, some = batch
                    fms = models.fit_many(p, name, [json.loads(t["hyper_parameters"]) for t in some], seed)
                    return [(int(t["replication_id"]), name, t["sampling_type"], score(fm, held, held_rows, p.labels),
                             t["hyper_parameters"]) for t, fm in zip(some, fms, strict=True)]

                boosted = [t for t in ts if t["model_name"] == "xg"]
                batches = [("xg", boosted[i:i + BOOSTED]) for i in range(0, len(boosted), BOOSTED)]
                batches += [(t["model_name"], [t]) for t in ts if t["model_name"] != "xg"]
                for rows in ex.map(run, batches):
                    out += rows
                p.release()
            held.unpersist()
    return out


__all__ = ["hp_trials", "trial_grid", "cv_summary", "best_per_combo", "best_combo", "leaderboard",
           "cv_scores", "CV_SCHEMA"]
