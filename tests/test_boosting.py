"""Histogram boosting: the same trees as a brute-force learner, every parameter, weights, loss by round, storage."""

import json
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabclass.operators import boosting as B

N, K = 200, 3


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    x = np.stack([r.integers(0, 12, N), r.normal(size=N).round(2), r.integers(0, 2, N), np.full(N, 5.0)], axis=1)
    y = (x[:, 0] > 6).astype(int) + ((x[:, 1] > 0.3) & (x[:, 2] > 0)).astype(int)
    return x, np.where(r.random(N) < 0.1, r.integers(0, K, N), y)


@pytest.fixture(scope="module")
def frame(spark, rows):
    data = [(i, Vectors.dense(v), float(c), 1 + i % 3) for i, (v, c) in enumerate(zip(*map(np.ndarray.tolist, rows)))]
    return spark.createDataFrame(data, ["id", "features", "label", "copies"]).repartition(3).cache()


def hash_of(spark, ids):
    return np.array([r[0] for r in spark.createDataFrame([(int(i),) for i in ids], "id long")
                    .orderBy("id").select(F.xxhash64(F.col("id").cast("string"))).collect()], np.int64).view(np.uint64)


def brute(x, y, weight, hashes, p, seed, rounds):
    """One row at a time over sorted values; returns node rows as the model's."""
    m = np.zeros((len(y), K))
    out = []
    values = [sorted(set(x[:, j].tolist())) for j in range(x.shape[1])]
    for r in range(rounds):
        e = np.exp(m - m.max(axis=1, keepdims=True))
        prob = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(m)
        for c in range(K):
            number = r * K + c
            use = B.drawn(hashes, p.subsample, seed, number) if p.subsample < 1 else np.ones(len(y), bool)
            feats = B.tree_features(x.shape[1], p.colsample_bytree, seed, number)
            g = [round((prob[i, c] - (y[i] == c)) * B.UNIT) * int(weight[i]) for i in range(len(y))]
            h = [round(max(2 * prob[i, c] * (1 - prob[i, c]), 1e-16) * B.UNIT) * int(weight[i]) for i in range(len(y))]

            def sums(ids):
                return sum(g[i] for i in ids if use[i]) / B.UNIT, sum(h[i] for i in ids if use[i]) / B.UNIT

            def score(a, b):
                t = max(abs(a) - p.reg_alpha, 0.0)
                return t * t / (b + p.reg_lambda)

            nodes = [[r, c, 0, -1, None, None, None, B.leaf(*sums(range(len(y))), p)]]
            todo = [(0, list(range(len(y))), 0)]
            while todo:
                node, ids, depth = todo.pop(0)
                ag, ah = sums(ids)
                best = None
                if depth < p.max_depth:
                    for j in feats:
                        for v in values[j][1:]:
                            lg, lh = sums([i for i in ids if x[i, j] < v])
                            if not any(use[i] and x[i, j] < v for i in ids) or not any(use[i] and x[i, j] >= v for i in ids):
                                continue
                            rg, rh = ag - lg, ah - lh
                            if lh <= 0 or rh <= 0 or min(lh, rh) < p.min_child_weight:
                                continue
                            gain = score(lg, lh) + score(rg, rh) - score(ag, ah)
                            if best is None or gain > best[0]:
                                best = gain, j, v, (lg, lh), (rg, rh)
                if best is None or best[0] <= B.LEAST_GAIN or best[0] < p.gamma:
                    for i in ids:
                        step[i, c] = nodes[node][7]
                    continue
                _, j, v, left, right = best
                at = len(nodes)
                nodes[node][3:7] = [int(j), v, at, at + 1]
                nodes += [[r, c, at, -1, None, None, None, B.leaf(*left, p)], [r, c, at + 1, -1, None, None, None, B.leaf(*right, p)]]
                todo += [(at, [i for i in ids if x[i, j] < v], depth + 1), (at + 1, [i for i in ids if x[i, j] >= v], depth + 1)]
            out += nodes
        m = m + step
    return out


SETS = [dict(n_estimators=3, max_depth=3, learning_rate=0.3),
        dict(n_estimators=2, max_depth=4, learning_rate=0.1, reg_lambda=5, reg_alpha=0.5, gamma=0.3, min_child_weight=3),
        dict(n_estimators=3, max_depth=2, colsample_bytree=0.5, subsample=0.7, reg_lambda=0.1)]


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:4] == tuple(b[:4]) and a[5:7] == tuple(b[5:7]), (a, b)
        assert a[4] == b[4] and math.isclose(a[7], b[7], rel_tol=1e-9, abs_tol=1e-12), (a, b)


def test_same_trees_as_brute_force(spark, rows, frame):
    """All sets boosted together give the trees of each alone, by hand."""
    x, y = rows
    est = B.HistBoostClassifier(numClasses=K, idCol="id", seed=7)
    hashes = hash_of(spark, range(N))
    for m, p in zip(est.fit_many(frame, SETS), SETS, strict=True):
        p = B.BoostParams.of(p)
        same(m.node_rows(), brute(x, y, np.ones(N), hashes, p, 7, p.n_estimators))


def test_weights_are_copies(spark, rows, frame):
    x, y = rows
    copies = frame.withColumn("c", F.explode(F.sequence(F.lit(1), "copies")))
    p = json.dumps(SETS[1])
    a = B.HistBoostClassifier(numClasses=K, idCol="id", weightCol="copies", boostParams=p).fit(frame)
    b = B.HistBoostClassifier(numClasses=K, idCol="id", boostParams=p).fit(copies)
    assert a.node_rows() == b.node_rows()
    w = np.array([1 + i % 3 for i in range(N)])
    same(a.node_rows(), brute(x, y, w, hash_of(spark, range(N)), B.BoostParams.of(SETS[1]), 1, 2))


def test_partitions_and_staging_change_nothing(frame):
    data = B.binned(frame.withColumn("x", vector_to_array("features")), [np.arange(1.0, 12), np.array([0.0]), np.array([1.0]), np.array([])], "x")
    p = [B.BoostParams.of(dict(n_estimators=5, max_depth=2))]
    runs = [B.boost(d, K, 4, p, stage_every=s) for d, s in ((data, 16), (data.repartition(7), 2))]
    trees = [[(r, c, t.feature, t.cut, t.left, t.value) for r, c, t in run[0]] for run in runs]
    assert trees[0] == trees[1] and len(trees[0]) == 5 * K


def test_equal_rows_are_routed_once(spark, monkeypatch):
    """Rows of the same bins and label share margins, nodes and gradients in every pass; the trees are those of single rows."""
    r = np.random.default_rng(5)
    x, y = r.integers(0, 3, (3000, 2)), r.integers(0, K, 3000)
    d = spark.createDataFrame([(i, Vectors.dense(v), float(c)) for i, (v, c) in enumerate(zip(x.tolist(), y.tolist()))],
                              ["id", "features", "label"]).coalesce(1)
    data = B.binned(d.withColumn("x", vector_to_array("features")), [np.array([1.0, 2.0])] * 2, "x").cache()
    calls, route = spark.sparkContext.accumulator(0), B.route

    def counting(bins, tree):
        calls.add(len(bins))
        return route(bins, tree)

    monkeypatch.setattr(B, "route", counting)
    p = [B.BoostParams.of(dict(n_estimators=2, max_depth=2, subsample=0.7))]
    whole = B.boost(data, K, 2, p)[0]
    # 4 passes; in each, K trees of the round and K of the round before at most, over 27 distinct rows
    assert 0 < calls.value <= 4 * 2 * K * 27
    monkeypatch.setattr(B, "CHUNK", 8 * K + 30)  # a row a chunk
    single = B.boost(data, K, 2, p)[0]
    assert [(r, c, t.feature, t.cut, t.left, t.value) for r, c, t in whole] == [
        (r, c, t.feature, t.cut, t.left, t.value) for r, c, t in single]


def test_every_parameter_takes_effect(frame):
    base = dict(n_estimators=2, max_depth=3, subsample=1.0)
    other = dict(learning_rate=0.01, n_estimators=1, max_depth=1, gamma=2.0, colsample_bytree=0.3, subsample=0.5, reg_alpha=3.0,
                 reg_lambda=50.0, min_child_weight=20.0)
    fits = B.HistBoostClassifier(numClasses=K, idCol="id").fit_many(frame, [base, *[{**base, k: v} for k, v in other.items()]])
    first = fits[0].node_rows()
    assert all(m.node_rows() != first for m in fits[1:])
    with pytest.raises(ValueError, match="unknown"):
        B.BoostParams.of({"max_dept": 3})


def test_loss_by_round_and_storage(spark, rows, frame, tmp_path):
    x, y = rows
    m = B.HistBoostClassifier(numClasses=K, idCol="id", boostParams=json.dumps(SETS[0])).fit(frame)
    got = {(r["set"], r["n_trees"]): r["loss"] for r in m.evaluate_each_round(
        frame.withColumn("set", F.when(F.col("id") % 4 == 0, "validation").otherwise("train"))).collect()}
    nodes = defaultdict(dict)
    for r, c, i, f, cut, left, right, v, _ in m.node_rows():
        nodes[r, c][i] = f, cut, left, right, v
    margin, want = np.zeros((N, K)), {}
    for r in range(3):
        for c in range(K):
            for i in range(N):
                at = 0
                while nodes[r, c][at][0] >= 0:
                    f, cut, left, right, _ = nodes[r, c][at]
                    at = left if x[i, f] < cut else right
                margin[i, c] += nodes[r, c][at][4]
        p = np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True)
        loss = -np.log(p[np.arange(N), y])
        for s, pick in (("validation", np.arange(N) % 4 == 0), ("train", np.arange(N) % 4 != 0)):
            want[s, r + 1] = loss[pick].mean()
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    assert got["train", 3] < got["train", 1]
    PipelineModel([m]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert back.node_rows() == m.node_rows() and back.n_classes == K
    a, b = ([tuple(r) for r in k.transform(frame).orderBy("id").select("prediction", "probability", "rawPrediction").collect()]
            for k in (m, back))
    assert a == b
    assert np.allclose([r[1].toArray() for r in a], np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True))


def test_cuts(spark):
    d = spark.range(1000).select(F.col("id").cast("double").alias("many"), (F.col("id") % 3).alias("few"), F.lit(None).cast("double").alias("none"))
    many, few, none = B.feature_cuts(d, ["many", "few", "none"], 16)
    assert len(many) == 15 and few.tolist() == [1.0, 2.0] and len(none) == 0
    assert max(abs(c - 62.5 * (i + 1)) for i, c in enumerate(many)) < 5
