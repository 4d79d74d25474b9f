"""Exact neighbours by cells against brute force, groups, copies, hot vectors, and how much is compared."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabclass.operators import knn as knn_mod
from tabclass.operators import knn_cells


def brute(q, c, k, exclude_self):
    out = {}
    for i, g, x in q:
        near = sorted((float(np.sum((np.array(x) - np.array(y)) ** 2)), j) for j, h, y in c
                      if g == h and not (exclude_self and i == j))[:k]
        out[i] = [j for _, j in near]
    return out


@pytest.mark.parametrize("exclude_self", [False, True])
@pytest.mark.parametrize("block", [16, 4096])
def test_cells_equal_brute_force(spark, exclude_self, block, monkeypatch):
    monkeypatch.setattr(knn_cells, "QUERY_ROWS", 50)
    r = np.random.default_rng(3)
    x = np.concatenate([np.round(r.normal(size=(250, 2)) * 4), np.tile([[2.0, 2.0]], (60, 1)), r.normal(size=(90, 2)) * 100])
    rows = [(int(i), None if i % 50 == 7 else "ab"[i % 2], v.tolist()) for i, v in enumerate(x)]
    rows += [r for r in rows if r[0] in (3, 251)] * 3  # candidates may repeat an id
    d = spark.createDataFrame(rows, "id long, g string, features array<double>")
    q = d.dropDuplicates(["id"])
    got = {}
    for n in sorted(knn_mod.knn(q, d, 4, part_cols=["g"], exclude_self=exclude_self, block_rows=block, carry=["features"]).collect(),
                    key=lambda n: (n.qid, n.nn_rank)):
        got.setdefault(n.qid, []).append(n.cid)
        assert n.dist == pytest.approx(np.linalg.norm(np.array(rows[n.qid][2]) - np.array(n.features)))
    want = brute([r for r in rows[:400]], rows, 4, exclude_self)
    assert got == {i: v for i, v in want.items() if v}


def test_far_cells_are_not_compared(spark):
    """Comparisons grow with the rows, not with their square."""
    r = np.random.default_rng(5)
    x = r.random((4096, 2))
    cells = knn_cells.Cells(2)
    cells.grow((), x, 64)
    home = cells.route(x, np.zeros(len(x), int))
    cells.close({c: (x[home == c].min(axis=0), x[home == c].max(axis=0)) for c in np.unique(home)})
    row, cell = cells.within(x, np.zeros(len(x), int), np.full(len(x), 0.03))
    assert len(np.unique(home)) >= 64 and len(row) < 4 * len(x)
    lo, hi = cells.lo[np.unique(home)], cells.hi[np.unique(home)]
    d = np.maximum(np.maximum(lo[None] - x[:, None], x[:, None] - hi[None]), 0)
    assert len(row) == int((np.sqrt((d ** 2).sum(-1)) <= 0.03).sum())  # and none is missed


def test_alike_candidates_stay_few(spark):
    d = spark.range(3000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("cf")).withColumnRenamed("id", "cid")
    assert sorted(r.cid for r in knn_cells._thinned(d, [], 3, False).collect()) == [0, 1, 2]
    assert sorted(r.cid for r in knn_cells._thinned(d, [], 3, True).collect()) == [0, 1, 2, 3, 4, 5]
