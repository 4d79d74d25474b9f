"""Split, folds and samplers: counts and guarantees."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabclass.functions.hashing import hash32
from tabclass.functions.quantiles import exact_quantiles
from tabclass.functions.ranking import rank_steps, rank_within
from tabclass.operators import prep, sampling, smote, split
from tabclass.sources import fixtures as fx
from tests.conftest import SF_SMALL, SF_TINY


def _ord(spark, sf=SF_TINY):
    return prep.prep_columns(fx.f_ord(spark, sf), "row_id", "status")


def _rare(spark, sf=SF_TINY):
    return prep.prep_columns(fx.f_rare(spark, sf), "row_id", "status")


def test_split_shares_and_disjoint(spark):
    d = split.stratified_split(_ord(spark))
    rows = d.groupBy("target", "split").count().collect()
    n = {}
    for r in rows:
        n.setdefault(r["target"], {})[r["split"]] = r["count"]
    for c, parts in n.items():
        tot = sum(parts.values())
        assert parts.get("validation", 0) == int(np.floor(tot * 0.33 + 0.5))
        if tot >= 2:
            assert parts.get("train", 0) >= 1 and parts.get("validation", 0) >= 1
    assert d.count() == d.select("id").distinct().count() == _ord(spark).count()


def _sklearn_like_folds(y, k):
    # brute-force statement of StratifiedKFold(shuffle=False) fold allocation
    _, y_idx, y_inv = np.unique(y, return_index=True, return_inverse=True)
    _, class_perm = np.unique(y_idx, return_inverse=True)
    enc = class_perm[y_inv]
    n_classes = len(y_idx)
    order = np.sort(enc)
    alloc = np.asarray([np.bincount(order[i::k], minlength=n_classes) for i in range(k)])
    out = np.empty(len(y), dtype=int)
    for c in range(n_classes):
        out[enc == c] = np.arange(k).repeat(alloc[:, c])
    return out


@pytest.mark.parametrize("k", [3, 5])
def test_kfold_matches_brute_force(spark, k):
    train = split.stratified_split(_ord(spark)).where("split = 'train'").drop("split")
    got = split.stratified_kfold(train, k, n_buckets=7).select("id", "target", "fold").orderBy("id").collect()
    y = np.array([r["target"] for r in got])
    assert [r["fold"] for r in got] == list(_sklearn_like_folds(y, k))


def test_rank_steps_equal_plain_ranks_and_sort_few_rows(spark):
    at = F.col("id")
    d = spark.range(0, 6000, 1, 4).select(F.floor(at / 2).alias("id"), F.concat(F.lit("c"), (at % 5 % 3).cast("string")).alias("target"))
    n = {r["target"]: r["count"] for r in d.groupBy("target").count().collect()}
    cuts = {t: [0, k // 7, k // 7, k // 2, k - 1, k, k + 9] for t, k in n.items()}
    table = spark.createDataFrame(list(cuts.items()), "target string, cuts array<long>")
    got = rank_steps(d, "target", ["id"], table, n_buckets=16)
    rank = F.row_number().over(Window.partitionBy("target").orderBy("id"))
    want = sorted((r["target"], r["id"], sum(c < r["r"] for c in cuts[r["target"]])) for r in d.withColumn("r", rank).collect())
    assert sorted((r["target"], r["id"], r["step"]) for r in got.collect()) == want  # ids come twice in a class or not
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Window [") == 1  # rows away from the cuts pass no window


def test_split_ranks_only_the_bucket_of_the_cut(spark):
    plan = split.stratified_split(_ord(spark))._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "____s_lo" in window and "____s_hi" in window and plan.count("Window [") == 1


def test_rank_within_equals_plain_window(spark):
    d = _ord(spark, SF_SMALL).withColumn("h", hash32(7, F.col("id")))
    two = rank_within(d, ["target"], ["h", "id"], out="r2", n_buckets=16)
    plain = d.withColumn("r1", F.row_number().over(Window.partitionBy("target").orderBy("h", "id")))
    j = two.join(plain.select("id", "r1"), "id")
    assert j.where("r1 <> r2").count() == 0 and j.count() == d.count()


def test_exact_quantiles_brute_force(spark):
    s = fx.f_scored(spark, SF_SMALL)
    qs = [0.0, 0.05, 0.25, 0.5, 0.9, 0.99, 1.0]
    for col in ("purchase", "id"):
        vals = np.array([r[0] for r in s.select(col).collect()], dtype=float)
        got = exact_quantiles(s, col, qs, n_buckets=8)
        assert got == pytest.approx(list(np.quantile(vals, qs)), rel=1e-12, abs=1e-12)
    # heavy ties: one value repeated thousands of times
    m = fx.f_ord(spark, SF_SMALL).select(F.least(F.col("m"), F.lit(3)).alias("m"))
    vals = np.array([r[0] for r in m.collect()], dtype=float)
    assert exact_quantiles(m, "m", qs) == pytest.approx(list(np.quantile(vals, qs)))


def test_under_and_over_sample_counts(spark):
    d = _rare(spark)
    counts = {r["target"]: r["count"] for r in d.groupBy("target").count().collect()}
    us = sampling.under_sample(d)
    assert {r["target"]: r["count"] for r in us.groupBy("target").count().collect()} == \
        {c: min(counts.values()) for c in counts}
    os_ = sampling.over_sample(d)
    assert {r["target"]: r["count"] for r in os_.groupBy("target").count().collect()} == \
        {c: max(counts.values()) for c in counts}
    # deterministic under repartition
    a = sorted(r["id"] for r in sampling.under_sample(d.repartition(5)).collect())
    assert a == sorted(r["id"] for r in us.collect())


def test_smote_points_on_segments(spark):
    d = _rare(spark)
    feats = ["o_totalprice", "o_custkey", "m"]
    s = smote.smote(d, feats)
    counts = {r["target"]: r["count"] for r in s.groupBy("target").count().collect()}
    assert len(set(counts.values())) == 1
    syn = s.where("synthetic").alias("s")
    base = d.select("id", *[F.col(c).cast("double").alias(f"a_{c}") for c in feats])
    nb = d.select(F.col("id").alias("nb_id"), *[F.col(c).cast("double").alias(f"b_{c}") for c in feats])
    j = syn.join(base, "id").join(nb, "nb_id").collect()
    assert j
    for r in j:
        for c in feats:
            assert r[c] == pytest.approx(r[f"a_{c}"] + r["u"] * (r[f"b_{c}"] - r[f"a_{c}"]))
        assert 0.0 <= r["u"] < 1.0


def test_smote_small_class_raises(spark):
    full = _rare(spark)
    d = full.where("target = 'no'").unionByName(full.where("target = 'yes'").orderBy("id").limit(3))
    with pytest.raises(ValueError):
        smote.smote(d, ["o_totalprice"], k=5)


def test_adaptive_buckets_give_same_results(spark, monkeypatch):
    """Force the large-data paths (thousands of buckets) on small data."""
    from tabclass.functions import ranking

    d = _ord(spark, SF_SMALL)
    base_split = sorted((r["id"], r["split"]) for r in split.stratified_split(d).collect())
    s = fx.f_scored(spark, SF_SMALL)
    qs = [0.0, 0.3, 0.5, 0.99, 1.0]
    base_q = exact_quantiles(s, "purchase", qs)
    train = split.stratified_split(d).where("split = 'train'").drop("split")
    base_fold = sorted((r["id"], r["fold"]) for r in split.stratified_kfold(train, 5).collect())
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 3)
    assert ranking.hash_bits_for(5000) > 8 and ranking.buckets_for(10000) > 64
    assert sorted((r["id"], r["split"]) for r in split.stratified_split(d).collect()) == base_split
    assert exact_quantiles(s, "purchase", qs) == pytest.approx(base_q)
    assert sorted((r["id"], r["fold"]) for r in split.stratified_kfold(train, 5).collect()) == base_fold
    vals = np.array([r[0] for r in s.select("purchase").collect()])
    assert base_q == pytest.approx(list(np.quantile(vals, qs)))


def test_kfold_needs_rows(spark):
    d = _ord(spark).groupBy("target").agg(F.min("id").alias("id"))  # one row per class
    with pytest.raises(ValueError):
        split.stratified_kfold(d, 3)
