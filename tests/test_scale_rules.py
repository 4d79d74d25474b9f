"""One code path at every size, spread work, ids of any type, safe names and sinks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclass.functions import quantiles, rowwise
from tabclass.operators import knn as knn_mod
from tabclass.operators import models, sampling, search, split
from tabclass.operators.smote import smote
from tabclass.sources import sinks


@pytest.mark.parametrize("classes", [20, 20000])
def test_lookup_is_a_left_join_at_every_size(spark, classes):
    small = spark.range(classes).selectExpr("cast(id as string) k", "id v")
    df = spark.range(classes + 5).selectExpr("cast(id as string) k")  # five keys are missing
    got = rowwise.lookup_small(df, small, "k", ["v"])
    assert got.count() == classes + 5 and got.where("v is null").count() == 5
    assert got.where("v <> cast(k as long)").count() == 0


def test_few_rows_make_a_class_in_many_tasks(spark):
    n = 30000
    d = spark.range(n).select("id", F.when(F.col("id") < 2, "rare").otherwise("often").alias("target"))
    out = sampling.over_sample(d).where("target = 'rare'")
    by = out.groupBy(F.spark_partition_id()).count().collect()
    total = sum(r["count"] for r in by)
    assert total == n - 2 and len(by) >= 4 and max(r["count"] for r in by) < 0.6 * total
    assert out.select("id", "copy_no").distinct().count() == n - 2


def brute(q, c, k):
    out = {}
    for i, x in q.items():
        near = sorted((float(np.sum((np.array(x) - np.array(y)) ** 2)), j) for j, y in c.items())[:k]
        out[i] = [j for _, j in near]
    return out


@pytest.mark.parametrize("block", [4, 4096])
def test_knn_text_ids_ties_and_nans(spark, block):
    r = np.random.default_rng(1)
    q = {f"q{i}": r.integers(0, 4, 3).astype(float).tolist() for i in range(40)}
    c = {f"c{i:02d}": r.integers(0, 4, 3).astype(float).tolist() for i in range(60)}
    qd = spark.createDataFrame(list(q.items()), "id string, features array<double>")
    cd = spark.createDataFrame([*c.items(), ("c_nan", [float("nan")] * 3)], "id string, features array<double>")
    rows = knn_mod.knn(qd, cd, 4, block_rows=block).collect()
    got = {}
    for x in sorted(rows, key=lambda x: (x.qid, x.nn_rank)):
        got.setdefault(x.qid, []).append(x.cid)
    assert got == brute(q, c, 4)


def test_top_is_exact_far_from_the_origin():
    r = np.random.default_rng(2)
    X, Y = 1e6 + r.random((50, 3)), 1e6 + r.random((300, 3))
    qi, ci, dist = knn_mod._top(X, Y, np.arange(50), np.arange(300) + 1000, 5, False)
    want = np.sort(np.sqrt(((X[:, None] - Y[None]) ** 2).sum(-1)), axis=1)[:, :5]
    assert np.allclose(dist.reshape(50, 5), want, rtol=1e-12, atol=0) and list(qi) == list(np.repeat(np.arange(50), 5))


def test_text_ids_for_smote_and_folds(spark):
    rows = [(f"id{i:03d}", float(i % 7), float(i), "a" if i < 8 else "b") for i in range(40)]
    d = spark.createDataFrame(rows, "id string, x double, y double, target string")
    out = smote(d, ["x", "y"], k=3)
    assert {r["target"]: r["count"] for r in out.groupBy("target").count().collect()} == {"a": 32, "b": 32}
    new = out.where("synthetic").collect()
    assert all(r.nb_id.startswith("id") and r.nb_id != r.id for r in new)
    folds = split.stratified_kfold(d, 4)
    got = {r.id: r.fold for r in folds.collect()}
    for t in "ab":  # in id order, as for numbers
        ids = sorted(r[0] for r in rows if r[3] == t)
        assert [got[i] for i in ids] == sorted(got[i] for i in ids)


def test_smote_refuses_nulls(spark):
    d = spark.createDataFrame([(i, None if i == 3 else float(i), "a" if i < 8 else "b") for i in range(20)],
                              "id long, x double, target string")
    with pytest.raises(ValueError, match="impute"):
        smote(d, ["x"], k=3)


def test_stored_empty_parameters_are_stored_parameters(spark):
    combos = spark.createDataFrame([("rf", "NA", 0)], "model_name string, sampling_type string, ord int")
    assert search.hp_trials(combos, stored_params={}).count() == 1
    assert search.hp_trials(combos, stored_params=None).count() == 20


def test_too_deep_trees_are_refused():
    with pytest.raises(ValueError, match="max_depth"):
        models.map_params("rf", {"max_depth": 31})


def test_features_with_odd_names(spark):
    d = spark.createDataFrame([(i, float(i % 4), float(i % 3), "it's" if i % 4 < 2 else "yes.1") for i in range(60)],
                              "id long, `a.x` double, `b'y` double, target string")
    fm = models.fit_model(d, ["a.x", "b'y"], "dt", "NA", {"max_depth": 3})
    p = models.predict(fm, d, keep=("id", "a.x", "target"))
    assert p.where("pred <> target").count() == 0 and "a.x" in p.columns and p.count() == 60


def test_quantiles_go_deeper_for_large_cells(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(f"g{i % 3}", float(v)) for i, v in enumerate(np.round(r.exponential(10, 3000), 2))]
    rows += [("hot", 5.0)] * 500 + [("one", 1.5)]
    d = spark.createDataFrame(rows, "g string, v double")
    qs = (0.0, 0.1, 0.5, 0.77, 1.0)
    want = {g: np.quantile([v for k, v in rows if k == g], qs) for g in {k for k, _ in rows}}
    for size in (2_000_000, 20):  # 20 rows a cell: several rounds
        monkeypatch.setattr(quantiles, "ROWS_PER_BUCKET", size)
        got = quantiles.grouped_exact_quantiles(d, "g", "v", qs, n_buckets=8)
        assert set(got) == set(want)
        for g, v in want.items():
            assert got[g] == pytest.approx(list(v))


def test_cells_are_cut_without_a_list_walk(spark):
    """A value finds its cell in a step per bit of the bounds, not by a function run over all of them."""
    rows = [(i % 3, float(i * 37 % 101)) for i in range(600)] + [(0, float("inf"))] * 2 + [(1, float("-inf")), (2, float("nan"))]
    d = spark.createDataFrame(rows, "cell long, v double")
    cells = quantiles._cells(d, 16)
    assert "filter(" not in cells._jdf.queryExecution().optimizedPlan().toString()
    got = [(r["cell"], (np.isnan(r["v"]), r["v"]), r["bk"]) for r in cells.collect()]
    assert len(got) == len(rows)
    for c in range(3):
        mine = sorted((v, b) for k, v, b in got if k == c)
        assert [b for _, b in mine] == sorted(b for _, b in mine) and len({b for _, b in mine}) >= 15


def test_unreadable_table_is_not_an_absent_one(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    assert not sinks.table_at(spark, str(path))
    (path / "part-0.parquet").write_bytes(b"not parquet")
    assert sinks.table_at(spark, str(path))
    new = spark.createDataFrame([(1, "m")], "id long, model_id string")
    with pytest.raises(Exception):  # noqa: B017
        sinks.persist_data(new, str(path), ["id"])
    assert (path / "part-0.parquet").read_bytes() == b"not parquet"


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_results(spark.range(3), path)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):  # noqa: B017
        sinks.write_results(bad, path)
    assert spark.read.parquet(path).count() == 3
    sinks.write_results(spark.read.parquet(path).where("id > 0"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir() if "__old" in p.name] == []


def test_staging_stays_out_of_temp_folders():
    import inspect

    from tabclass import session
    assert "tempfile" not in inspect.getsource(session)
