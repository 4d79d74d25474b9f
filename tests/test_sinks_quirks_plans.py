"""Sinks, reference quirks (Q1, Q2, Q11, Q13) and physical-plan checks."""

import pytest
from pyspark.sql import functions as F

from tabclass.operators import prep
from tabclass.sources import fixtures as fx
from tabclass.sources import sinks, tables
from tests.conftest import SF_TINY


def test_upsert_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "t")
    base = fx.f_ord(spark, SF_TINY).select("row_id", "status", "o_totalprice")
    sinks.persist_data(base, path, ["row_id"])
    new = base.where("status = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    once = sorted(map(tuple, sinks.persist_data(new, path, ["row_id"]).collect()))
    twice = sorted(map(tuple, sinks.persist_data(new, path, ["row_id"]).collect()))
    assert once == twice and len(once) == base.count()


def test_replace_by_key_keeps_other_models(spark, tmp_path):
    path = str(tmp_path / "reg")
    a = spark.createDataFrame([("m1", 1.0), ("m2", 2.0)], "model_id string, v double")
    sinks.replace_by_key(a, path)
    out = sinks.replace_by_key(spark.createDataFrame([("m1", 9.0)], "model_id string, v double"), path)
    assert sorted((r["model_id"], r["v"]) for r in out.collect()) == [("m1", 9.0), ("m2", 2.0)]


def test_replace_by_an_empty_table(spark, tmp_path):
    """The key's rows go, other models' stay; also where nothing else is left, and with odd key values."""
    path = str(tmp_path / "reg")
    a = spark.createDataFrame([("m/1 =x", 1.0), ("2", 2.0)], "model_id string, v double")
    sinks.replace_by_key(a, path)
    out = sinks.replace_by_key(a.where("false"), path, "model_id", ["m/1 =x"])
    assert [tuple(r) for r in out.select("model_id", "v").collect()] == [("2", 2.0)]
    assert sinks.replace_by_key(a.where("false"), path, "model_id", ["2"]).count() == 0


def test_run_log_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "log")
    kinds = {k: spark.createDataFrame([(f"{k}-1", 1.5), (f"{k}-2", 2.5)], "name string, value double") for k in ("param", "metric")}
    sinks.log_kinds(kinds, path, "0123", "m", "r")
    sinks.log_kinds(kinds, path, "77e1", "m", "r")
    out = sinks.log_kinds(kinds, path, "0123", "m", "r")
    assert sorted((r.run_id, r.kind, r.name, r.value) for r in out.collect()) == sorted(
        (i, k, f"{k}-{n}", f"{n}.5") for i in ("0123", "77e1") for k in kinds for n in (1, 2))


def test_read_or_empty_only_for_missing(spark):
    like = fx.f_ord(spark, SF_TINY)
    assert tables.read_or_empty(spark, "nope", like, SF_TINY).count() == 0
    assert tables.read_or_empty(spark, "orders", like, SF_TINY).count() > 0


def test_jdbc_options_require_bounds():
    o = tables.jdbc_options("jdbc:x://h/db", "t", partition_column="id", lower_bound=0, upper_bound=9,
                            num_partitions=4)
    assert o["numPartitions"] == "4" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_quirks(spark):
    nul = prep.prep_columns(fx.f_null(spark, SF_TINY), "row_id", "status")
    assert nul.where("target = 'nan'").count() > 0                              # Q1
    extra = prep.with_actual(fx.f_extra(spark, SF_TINY), "status")
    assert {r[0] for r in extra.select("status_actual").distinct().collect()} == {"NA"}  # Q2
    al = prep.align_features(fx.f_extra(spark, SF_TINY), ["o_custkey", "gone"], keep=["row_id"])
    assert al.columns == ["row_id", "o_custkey", "gone"] and al.where("gone <> 0").count() == 0  # Q11
    d = fx.f_ord(spark, SF_TINY).withColumnRenamed("row_id", "id")
    assert prep.prep_columns(d, "id", "status").columns[0] == "id"                 # Q13
    assert prep.safe_names(fx.f_extra(spark, SF_TINY)).columns[-1] == "pred_1"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replace_by_key_writes_its_rows_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.replace_by_key(spark.createDataFrame([("m1", 1.0), ("m2", 2.0)], "model_id string, v double"), path)
    monkeypatch.setattr(sinks, "scratch_path", lambda *a: pytest.fail("written a second time"))
    mine = spark.read.parquet(path).where("model_id = 'm1'").select(F.col("model_id"), (F.col("v") * 5).alias("v"))
    out = sinks.replace_by_key(mine, path, "model_id", ["m1", "m3"])  # reads what it replaces
    assert sorted(map(tuple, out.select("model_id", "v").collect())) == [("m1", 5.0), ("m2", 2.0)]
    bad = spark.range(1).select(F.lit("m2").alias("model_id"), F.raise_error(F.lit("no")).cast("double").alias("v"))
    with pytest.raises(Exception):  # noqa: B017
        sinks.replace_by_key(bad, path)
    assert spark.read.parquet(path).where("model_id = 'm2'").first()["v"] == 2.0


def test_scan_prunes_and_pushes(spark):
    df = tables.read_table(spark, "orders", SF_TINY).where(F.col("o_totalprice") > 1000).select("o_orderkey")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


@pytest.mark.parametrize("key", ["stratified_split", "stratified_kfold", "under_sample", "classification_report"])
def test_no_single_partition_window(spark, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF_TINY)
    df.collect()
    lines = _plan(df).splitlines()
    windows = [i for i, ln in enumerate(lines) if "Window [" in ln]
    for i in windows:  # the exchange feeding each window must be keyed, not SinglePartition
        below = next((ln for ln in lines[i + 1:] if "Exchange" in ln), "")
        assert "SinglePartition" not in below, lines[i]


def test_partitioned_upsert_touches_one_model(spark, tmp_path):
    path = str(tmp_path / "res")
    a = spark.createDataFrame([("m1", 1, 1.0), ("m1", 2, 2.0), ("m2", 1, 5.0)], "model_id string, id int, v double")
    sinks.persist_data(a, path, ["model_id", "id"], partition_by="model_id")
    new = spark.createDataFrame([("m1", 2, 9.0), ("m1", 3, 3.0)], "model_id string, id int, v double")
    out = sinks.persist_data(new, path, ["model_id", "id"], partition_by="model_id")
    got = sorted((r["model_id"], r["id"], r["v"]) for r in out.collect())
    assert got == [("m1", 1, 1.0), ("m1", 2, 9.0), ("m1", 3, 3.0), ("m2", 1, 5.0)]
    again = sinks.persist_data(new, path, ["model_id", "id"], partition_by="model_id")
    assert sorted((r["model_id"], r["id"], r["v"]) for r in again.collect()) == got
