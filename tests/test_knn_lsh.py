"""Approximate neighbours: recall against exact search, whole results, dense buckets, repeated ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclass.operators.knn import knn
from tabclass.operators.knn_lsh import knn_lsh, search


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(30, 8)) * 8
    x = np.concatenate([centres[r.integers(0, 30, 2400)] + r.normal(size=(2400, 8)), r.uniform(-30, 30, (40, 8))])
    rows = [(i, "ab"[i % 2], v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, g string, features array<double>").repartition(4).cache()


def pairs(nn):
    return {(r["qid"], r["cid"]) for r in nn.collect()}


@pytest.mark.parametrize("block_rows", [4096, 60])
def test_recall_and_whole_results(points, block_rows):
    want = knn(points, points, 5, part_cols=["g"], exclude_self=True)
    got = knn_lsh(points, points, 5, part_cols=["g"], exclude_self=True, block_rows=block_rows, carry=["features"])
    rows = got.collect()
    assert len(rows) == 5 * points.count() and sorted({r["nn_rank"] for r in rows}) == [1, 2, 3, 4, 5]
    at = {r["id"]: (r["g"], np.array(r["features"])) for r in points.collect()}
    for r in rows[::97]:  # exact distances, the same group, never itself
        assert r["qid"] != r["cid"] and at[r["qid"]][0] == at[r["cid"]][0] == r["g"]
        assert r["dist"] == pytest.approx(np.linalg.norm(at[r["qid"]][1] - np.array(r["features"])))
    found = {(r["qid"], r["cid"]) for r in rows}
    assert len(found & pairs(want)) >= 0.9 * len(pairs(want))


def test_too_narrow_buckets_fall_back_to_exact(points):
    some = points.where("id < 300")
    got = knn_lsh(some, some, 3, exclude_self=True, width=1e-6, carry=["g"])
    assert pairs(got) == pairs(knn(some, some, 3, exclude_self=True))


def test_copies_and_bad_vectors(spark):
    d = spark.createDataFrame([(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [5.0, 5.0]), (4, [float("nan"), 0.0])] +
                              [(9, [7.0, 7.0])] * 50, "id long, features array<double>")
    got = knn_lsh(d.where("id = 2"), d, 2, block_rows=8).orderBy("nn_rank").collect()
    assert [(r["cid"], r["nn_rank"]) for r in got] == [(2, 1), (1, 2)]
    got = knn_lsh(d.where("id = 3"), d, 3, block_rows=8, exclude_self=True, width=100.0).collect()
    assert [r["cid"] for r in got] == [9, 9, 9]
    with pytest.raises(ValueError, match="neighbours"):
        search("fast")


def test_small_buckets_share_a_group(spark):
    """A slot compares many buckets: groups grow with the rows, not with the buckets."""
    import pyarrow as pa

    from tabclass.operators.knn_lsh import runs
    t = pa.table({"g": ["a", None, "a", "b", None], "bucket": [1, 2, 1, 1, 2], "x": [[0.0], [1.0], [2.0], [3.0], [4.0]]})
    rows, found = runs(t, ["g", "bucket"])
    got = {k: sorted(v[0] for v in rows.slice(*at).column("x").to_pylist()) for k, at in found.items()}
    assert got == {("a", 1): [0.0, 2.0], (None, 2): [1.0, 4.0], ("b", 1): [3.0]}
