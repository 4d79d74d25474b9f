"""Grouped user models in shards, and several fitted models over one scan."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabclass.operators import models, prep, split
from tabclass.operators.grouped import map_groups
from tabclass.sources import fixtures as fx
from tests.conftest import SF_TINY


@pytest.mark.parametrize("max_rows", [1_000_000, 50, 7])
def test_shards_never_exceed_and_merge(spark, max_rows):
    d = (spark.range(700).select(F.when(F.col("id") < 600, "hot").when(F.col("id") < 690, "b").alias("g"), F.lit(1).alias("v"))
         .repartition(5))

    def fit(pdf):
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "n": [len(pdf)], "s": [int(pdf["v"].sum())]})

    def merge(pdf):
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "largest": [pdf["n"].max()], "total": [pdf["s"].sum()]})

    got = {r.g: (r.largest, r.total) for r in map_groups(d, "g", fit, "g string, n long, s long", merge,
                                                         "g string, largest long, total long", max_rows).collect()}
    assert {k: v[1] for k, v in got.items()} == {"hot": 600, "b": 90, None: 10}
    assert all(n <= 1.5 * max_rows + 5 for n, _ in got.values())


def test_ensemble_is_one_scan(spark, tmp_path):
    d = split.stratified_split(prep.prep_columns(fx.f_sep(spark, SF_TINY), "event_id", "band"))
    train, val = (d.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    val.write.parquet(str(tmp_path / "val"))
    val, feats = spark.read.parquet(str(tmp_path / "val")), ["value", "hr"]
    fitted = {f"{m}_{s}": models.fit_model(train, feats, m, s, p) for m, s, p in
              (("nb", "NA", {}), ("dt", "os", {"max_depth": 3}), ("xg", "NA", {"n_estimators": 2, "max_depth": 2}))}
    src = val.withColumnRenamed("target", "high")  # a column named like a class
    e = models.ensemble(fitted, src, keep=("id",))
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan parquet") == 1
    rows = {r["id"]: r for r in e.collect()}
    one = {n: {r["id"]: r for r in models.predict(fm, val).collect()} for n, fm in fitted.items()}
    assert len(rows) == val.count()
    for i, r in rows.items():
        assert r["ens_pred"] == max(p[i]["pred"] for p in one.values())
        assert r["mid"] == pytest.approx(sum(p[i]["mid"] for p in one.values()) / 3)
