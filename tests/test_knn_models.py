"""Exact kNN vs brute force; learners; model store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclass.operators import knn, models, prep, split
from tabclass.sources import fixtures as fx
from tests.conftest import SF_SMALL, SF_TINY


def test_knn_matches_brute_force(spark):
    v = fx.f_vec(spark, SF_TINY).select("id", F.col("embedding").cast("array<double>").alias("features"),
                                        F.col("label").alias("target"))
    rows = v.orderBy("id").collect()
    ids = np.array([r["id"] for r in rows])
    X = np.array([r["features"] for r in rows])
    # small blocks force many block pairs per query
    nn = knn.knn(v, v, 4, exclude_self=True, block_rows=40).select("qid", "cid", "nn_rank").collect()
    got = {}
    for r in nn:
        got.setdefault(r["qid"], {})[r["nn_rank"]] = r["cid"]
    for i in range(0, len(ids), 37):
        d = ((X - X[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        order = np.lexsort((ids, d))[:4]
        assert [got[ids[i]][k] for k in (1, 2, 3, 4)] == list(ids[order])


def test_knn_within_groups(spark):
    v = fx.f_vec(spark, SF_TINY).select("id", F.col("embedding").cast("array<double>").alias("features"),
                                        F.col("label").alias("target"))
    nn = knn.knn(v, v, 2, part_cols=["target"], exclude_self=True, block_rows=16)
    lab = v.select(F.col("id").alias("cid"), F.col("target").alias("ct"))
    assert nn.join(lab, "cid").where("target <> ct").count() == 0


def _sep(spark, sf):
    d = prep.prep_columns(fx.f_sep(spark, sf), "event_id", "band")
    s = split.stratified_split(d).cache()
    return s.where("split = 'train'").drop("split"), s.where("split = 'validation'").drop("split")


@pytest.mark.parametrize("model,params", [("nb", None), ("dt", {"max_depth": 5}),
                                          ("rf", {"n_estimators": 10, "max_depth": 5}),
                                          ("xg", {"n_estimators": 3, "max_depth": 3})])
def test_learners_beat_majority(spark, model, params):
    train, val = _sep(spark, SF_SMALL)
    fm = models.fit_model(train, ["value", "hr", "user_id"], model, "NA", params)
    p = models.predict(fm, val, keep=("id", "target"))
    acc = p.select(F.avg((F.col("target") == F.col("pred")).cast("double"))).first()[0]
    majority = val.groupBy("target").count().agg(F.max("count")).first()[0] / val.count()
    assert acc > majority
    probs = p.select(sum(F.col(c) for c in fm.labels).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert probs[0] == pytest.approx(1.0) and probs[1] == pytest.approx(1.0)


def test_model_roundtrip(spark, tmp_path):
    train, val = _sep(spark, SF_TINY)
    fm = models.fit_model(train, ["value", "hr", "user_id"], "dt", "NA", {"max_depth": 4})
    models.save_model(fm, str(tmp_path), "m1")
    back = models.load_model(spark, str(tmp_path), "m1")
    a = models.predict(fm, val).select("id", F.col("pred").alias("a"))
    b = models.predict(back, val).select("id", F.col("pred").alias("b"))
    assert a.join(b, "id").where("a <> b").count() == 0


def test_param_mapping_records_ignored():
    kw, ignored = models.map_params("rf", {"n_estimators": 10, "min_samples_split": 5, "max_depth": 30})
    assert kw == {"numTrees": 10, "maxDepth": 30} and ignored == ["min_samples_split"]


@pytest.mark.parametrize("model,params", [("nb", {}), ("dt", {"max_depth": 4, "min_samples_leaf": 6})])
def test_weights_equal_copies(spark, model, params):
    """Over-sampling as weights: the predictions of a fit on copied rows."""
    from tabclass.operators.sampling import over_sample
    d = prep.prep_columns(fx.f_rare(spark, SF_TINY), "row_id", "status")
    feats = ["o_totalprice", "o_custkey", "m"]
    weighted = models.prepare(d, feats, "os")
    assert weighted.frame.count() == d.count()  # no row is copied
    copied = over_sample(d).drop("copy_no")
    assert weighted.total_weight() == copied.count()
    a = models.predict(models.fit_prepared(weighted, model, params), d).select("id", F.col("pred").alias("a"))
    b = models.predict(models.fit_model(copied, feats, model, "NA", params), d).select("id", F.col("pred").alias("b"))
    assert a.join(b, "id").where("a <> b").count() == 0


def test_estimator_and_evaluator_are_stored(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from tabclass.operators.estimators import MacroFBetaEvaluator, ResampledClassifier
    train, val = _sep(spark, SF_TINY)
    est = ResampledClassifier(modelName="xg", samplingType="os", features=["value", "hr"],
                              hyperParameters='{"n_estimators": 2, "max_depth": 2}')
    est.write().overwrite().save(str(tmp_path / "est"))
    back = ResampledClassifier.load(str(tmp_path / "est"))
    assert back.extractParamMap().keys() == est.extractParamMap().keys()
    fitted = Pipeline(stages=[back]).fit(train)
    fitted.write().overwrite().save(str(tmp_path / "model"))
    ev = MacroFBetaEvaluator(beta=2.0)
    ev.write().overwrite().save(str(tmp_path / "ev"))
    scores = [e.evaluate(m.transform(val)) for m, e in (
        (fitted, ev), (PipelineModel.load(str(tmp_path / "model")), MacroFBetaEvaluator.load(str(tmp_path / "ev"))))]
    assert scores[0] == scores[1] > 0.5


def test_forest_partitions_grow_with_rows_and_trees(spark, monkeypatch):
    assert models.forest_parts(24_000_000, 266) * models.BAG_BYTES >= 24_000_000 * 266 * 4
    d = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("target"), (F.col("id") % 3).alias("x"))
    p = models.prepare(d, ["x"])
    assert models.spread(p.frame, 10).rdd.getNumPartitions() == p.frame.rdd.getNumPartitions()
    monkeypatch.setattr(models, "BAG_BYTES", 1000)
    wide = models.spread(p.frame, 10)
    assert wide.rdd.getNumPartitions() == 40 and wide.count() == 1000
    assert models.predict(models.fit_prepared(p, "rf", {"n_estimators": 10}), d, keep=("id", "target")).where("pred <> target").count() == 0
    p.release()
