"""ROC points without collinear ones, neighbours across range buckets, end points."""

import random

from pyspark.sql import functions as F

from tabclass.functions.ranking import next_values
from tabclass.plans import curves


def plain(rows):
    """(threshold, tps, fps) by brute force: drop a point whose two steps are equal."""
    scores = sorted({s for _, s in rows}, reverse=True)
    steps = [(sum(a == "p" and x == s for a, x in rows), sum(a != "p" and x == s for a, x in rows)) for s in scores]
    out, tp, fp = [(None, 0, 0)], 0, 0
    for i, (s, (a, b)) in enumerate(zip(scores, steps, strict=True)):
        tp, fp = tp + a, fp + b
        if i in (0, len(scores) - 1) or steps[i + 1] != (a, b):
            out.append((s, tp, fp))
    return sorted(out, key=str)


def test_corners_equal_brute_force(spark):
    rng = random.Random(5)
    mixed = [(rng.choice("pn"), round(rng.random(), 2)) for _ in range(400)]
    straight = [("p", 1.0 - i / 5000) for i in range(1000)] + [("n", 0.5 - i / 5000) for i in range(1000)]
    for rows in (mixed, straight, [("p", 0.3)], [("n", 0.5)] * 4, []):
        d = spark.createDataFrame(rows, "actual string, score double")
        got = [(r.threshold, r.tps, r.fps) for r in curves.roc_corners(d, "p", "score").collect()]
        assert sorted(got, key=str) == (plain(rows) if rows else [])
    assert len(plain(straight)) == 4  # straight runs keep their ends


def test_corners_by_key(spark):
    rng = random.Random(6)
    rows = {k: [(rng.choice("pnn"), round(rng.random(), 2)) for _ in range(n)] for k, n in (("a", 300), ("b", 50), ("c", 1))}
    d = spark.createDataFrame([(k, *r) for k, v in rows.items() for r in v], "k string, actual string, score double")
    got = curves.roc_corners(d, "p", "score", keys=["k"]).collect()
    for k, v in rows.items():
        assert sorted(((r.threshold, r.tps, r.fps) for r in got if r.k == k), key=str) == plain(v)


def test_next_across_buckets(spark):
    d = spark.range(500).select((F.col("id") * 3).alias("x"), (F.col("id") % 7).alias("v"), (F.col("id") % 2).alias("g"))
    for n in (1, 2, 37):
        got = {r.x: r.next_v for r in next_values(d, "x", ["v"], n_buckets=n).collect()}
        assert got == {3 * i: (i + 1) % 7 if i < 499 else None for i in range(500)}
        got = {r.x: r.next_v for r in next_values(d, "x", ["v"], "g", descending=True, n_buckets=n).collect()}
        assert got == {3 * i: (i - 2) % 7 if i > 1 else None for i in range(500)}


def test_pr_ends_at_precision_one(spark):
    d = spark.createDataFrame([("p", 0.9), ("n", 0.2)], "actual string, score double")
    got = sorted((r.recall, r.precision, r.threshold) for r in curves.pr_curve_closed(d, "p", "score").collect())
    assert got == [(0.0, 1.0, None), (1.0, 0.5, 0.2), (1.0, 1.0, 0.9)]
    assert curves.pr_curve_closed(d.where("false"), "p", "score").count() == 0


def test_auc_of_many_rows(spark):
    d = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "p").otherwise("n").alias("actual"),
                                    (F.col("id") % 4).cast("double").alias("score"))
    # positives score 0 or 2, negatives 1 or 3; the product of their numbers is above 2^31
    assert curves.roc_auc(d, "p", "score").first()["auc"] == 0.25
