"""Hand-worked confusion matrix and metric identities."""

import pytest
from pyspark.sql import functions as F

from tabclass.plans import metrics

# a->a 5, a->b 2, b->b 3, b->a 1, c->a 2, c->b 1 ; class c is never predicted
L_MATRIX = [("a", "a", 5), ("a", "b", 2), ("b", "b", 3), ("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]


@pytest.fixture()
def cm(spark):
    return spark.createDataFrame(L_MATRIX, "actual string, pred string, n long")


def test_report_by_hand(cm):
    rep = {r["value"]: r for r in metrics.classification_report(cm).collect()}
    assert rep["a"]["precision"] == 0.625 and rep["a"]["recall"] == round(5 / 7, 4)
    assert rep["a"]["f1_score"] == round(10 / 15, 4)
    assert rep["b"]["precision"] == 0.5 and rep["b"]["recall"] == 0.75 and rep["b"]["f1_score"] == 0.6
    assert rep["c"]["precision"] == 0.0 and rep["c"]["recall"] == 0.0 and rep["c"]["f1_score"] == 0.0
    acc = round(8 / 14, 4)
    assert [rep["accuracy"][c] for c in ("precision", "recall", "f1_score", "support")] == [acc] * 4
    assert rep["macro avg"]["precision"] == 0.375
    assert rep["macro avg"]["support"] == 14.0
    assert rep["weighted avg"]["recall"] == acc  # weighted recall = accuracy


def test_identities(cm):
    s1 = metrics.summary(cm, beta=1.0).first()
    assert s1["fbeta"] == pytest.approx(s1["f1"])
    assert s1["weighted_recall"] == pytest.approx(s1["accuracy"])
    norm = metrics.normalized_confusion(cm, digits=12)
    sums = {r["actual"]: r["s"] for r in norm.groupBy("actual").agg(F.sum("share").alias("s")).collect()}
    assert all(v == pytest.approx(1.0) for v in sums.values())
    dense = metrics.dense_confusion(cm)
    assert dense.count() == 9 and dense.where("n = 0").count() == 3


def test_focus_labels_absent_count_as_zero(cm):
    f = metrics.summary(cm, labels=["a", "zz"]).first()
    assert f["precision"] == pytest.approx(0.625 / 2)


def test_score_from_counts_matches_spark(cm):
    rows = [tuple(r) for r in cm.collect()]
    for b in (0.5, 1.0, 2.0):
        assert metrics.score_from_counts(rows, b) == pytest.approx(metrics.summary(cm, beta=b).first()["fbeta"])
    assert metrics.score_from_counts(rows, accuracy=True) == pytest.approx(8 / 14)
