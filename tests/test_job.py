"""Entry A (train, evaluate, score) and Entry B (stored model) end to end."""

from pyspark.sql import functions as F

from tabclass.config import JobConfig
from tabclass.plans.job import score_with_stored_model, train_job
from tabclass.sources import fixtures as fx
from tests.conftest import SF_TINY


def _cfg(**kw):
    base = dict(historic_table="events", prediction_table="events_scored", target="band", id_col="event_id",
                model_id="t-01", accuracy_focus="recall", target_focus=("high", "low"), models=("dt", "nb"),
                cv_kfold=3, cv_score_table="cv", cl_report_table="clrep", precision_buckets_table="pb")
    base.update(kw)
    return JobConfig(**base)


def test_train_job_then_stored_registry(spark, tmp_path):
    sep = fx.f_sep(spark, SF_TINY)
    root = str(tmp_path)
    res = train_job(spark, _cfg(), sep, sep, root)
    assert res.best_model in {"dt_NA", "nb_NA"}
    assert res.cv.count() == 2 * 3                     # 2 combos x 1 trial x 3 folds
    preds = res.predictions
    assert preds.count() == sep.count()
    assert {"id", "band", "band_actual", "model_id", "high", "low", "mid"} <= set(preds.columns)
    reg = spark.read.parquet(f"{root}/hyper_parameters")
    assert reg.count() == 1 and reg.first()["model_name"] == res.best_model
    assert spark.read.parquet(f"{root}/pb").count() == 24
    assert spark.read.parquet(f"{root}/clrep").where("percentile = 100").count() > 0
    assert spark.read.parquet(f"{root}/top_vars").count() == 1
    # not updating: the stored combo and its parameters are reused (one trial)
    res2 = train_job(spark, _cfg(is_update_model_param=False), sep, sep, root)
    assert res2.cv.select("model_name", "sampling_type").distinct().count() == 1
    assert res2.best_model == res.best_model
    # results are keyed on (model_id, id): a rerun does not duplicate rows
    assert spark.read.parquet(f"{root}/events_scored_results").count() == sep.count()


def test_score_with_stored_model(spark, tmp_path):
    sep = fx.f_sep(spark, SF_TINY)
    root = str(tmp_path)
    res = train_job(spark, _cfg(models=("dt",), model_id="t-02"), sep, sep, root)
    no_target = sep.drop("band").withColumn("extra", F.lit(1))
    top = spark.read.parquet(f"{root}/top_vars")
    out = score_with_stored_model(spark, no_target, f"{root}/models", "t-02", "event_id", "band", top_vars=top)
    assert out.count() == sep.count()
    assert {r[0] for r in out.select("band_actual").distinct().collect()} == {"NA"}   # Q2
    a = res.predictions.select("id", F.col("band").alias("a"))
    assert out.join(a, "id").where("band <> a").count() == 0
