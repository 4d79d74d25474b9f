"""Running counts from sorted chunks against plain counts by distinct score."""

import pytest
from pyspark.sql import functions as F

from tabclass.plans import curves, evaluate, score_chunks


def _rows(spark):
    at = F.col("id")
    score = F.when(at % 3 == 0, F.lit(1.0)).otherwise((at * 7919 % 997) / F.lit(1000.0))  # a third share one score
    d = spark.range(0, 3000, 1, 5).select(
        F.when(at % 4 == 0, "validation").otherwise("train").alias("set"),
        F.when(at * 31 % 10 < 4, "a").otherwise("b").alias("actual"), F.lit("a").alias("pred"),
        score.alias("a"),
        F.when(at == 7, F.lit(-0.0)).when(at == 8, F.lit(0.0)).otherwise(1 - score).alias("b"))
    return d


@pytest.mark.parametrize("size", [1 << 18, 50])
def test_running_points_equal_counts_by_score(spark, monkeypatch, size):
    monkeypatch.setattr(score_chunks, "CHUNK_ROWS", size)
    monkeypatch.setattr(score_chunks, "RANGE_ROWS", size)
    rows = _rows(spark)
    sizes = {r["set"]: r["count"] for r in rows.groupBy("set").count().collect()}
    got = score_chunks.running_points(rows, ["a", "b"], sizes, "a").cache()
    want = curves.running_counts(curves.class_counts(rows, ["a", "b"], keys=["set"]), ["set", "cls"]).cache()
    cols = ["set", "score", "pos", "neg", "cum_pos", "cum_neg", "P", "N"]
    points = [sorted(map(str, d.where(F.col("cls") == "a").select(cols).collect())) for d in (got.where("pos IS NOT NULL"), want)]
    assert points[0] == points[1]
    areas = {(r["set"], r["cls"]): r["a"] / (r["P"] * r["N"]) for r in got.where("pos IS NULL").groupBy("set", "cls")
             .agg(F.sum("area").alias("a"), F.max("P").alias("P"), F.max("N").alias("N")).collect()}
    assert areas == {(r["set"], r["cls"]): pytest.approx(r["auc"]) for r in curves.auc_of(want, ["set", "cls"]).collect()}
    if size == 50:  # every range is one group of its own: no key holds the scores of a class
        assert max(len(b) for b in score_chunks.score_bounds(rows, ["a", "b"], sizes).values()) > 5


def test_unlabelled_rows_and_absent_classes_count_as_neither(spark):
    rows = spark.createDataFrame([("s", None, 0.5, 0.5), ("s", "a", 0.9, 0.1), ("s", "a", 0.5, 0.5)],
                                 "`set` string, actual string, a double, b double")
    got = score_chunks.running_points(rows, ["a", "b"], {"s": 3}, "a").collect()
    assert sorted((r["score"], r["pos"], r["neg"], r["cum_pos"], r["P"], r["N"]) for r in got if r["pos"] is not None) == [
        (0.5, 1, 0, 2, 2, 0), (0.9, 1, 0, 1, 2, 0)]
    assert {r["cls"]: (r["P"], r["N"]) for r in got if r["pos"] is None} == {"a": (2, 0), "b": (0, 2)}


def test_scores_that_are_no_numbers_come_last(spark):
    rows = spark.createDataFrame([("s", "a", float("nan")), ("s", "b", None), ("s", "a", -1.0), ("s", "b", 2.0), ("s", "b", float("nan"))],
                                 "`set` string, actual string, a double")
    got = [r for r in score_chunks.running_points(rows, ["a"], {"s": 5}, "a").collect() if r["pos"] is not None]
    got.sort(key=lambda r: r["cum_pos"] + r["cum_neg"])
    assert [(str(r["score"]), r["pos"], r["neg"], r["cum_pos"], r["cum_neg"]) for r in got] == [
        ("2.0", 0, 1, 0, 1), ("-1.0", 1, 0, 1, 1), ("None", 0, 1, 1, 2), ("nan", 1, 1, 2, 3)]


def test_evaluate_keeps_its_chunks_small(spark):
    """The job's evaluation writes no row per set, class and score: only the first focus label's points."""
    rows = _rows(spark)
    t = evaluate.evaluate({"x": rows.drop("set")}, ["a", "b"], ["a"], 1.0)
    n = rows.select("a").distinct().count()
    assert t["roc"].count() == t["pr"].count() == n
