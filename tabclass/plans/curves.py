"""ROC / precision-recall points and AUC.

Rows are first collapsed to distinct scores (``groupBy(score)`` with counts of
positives and negatives: partial aggregation, so a score shared by a third of
the rows is one record per task). Running counts from the highest score down
come from :func:`running_sum` (range buckets + prefix offsets), never from a
window over the whole table. AUC is the rank-sum statistic with ties counted
half, computed per distinct score:
``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import next_values, running_sum
from ..functions.rowwise import qcol
from ..session import staged
from .metrics import _ratio


def score_counts(scored: DataFrame, positive: str, score_col: str, actual: str = "actual",
                 keys: Sequence[str] = ()) -> DataFrame:
    """(keys, score, pos, neg) per distinct score."""
    is_pos = (F.col(actual).cast("string") == F.lit(positive)).cast("bigint")
    return (scored.select(*keys, qcol(score_col).cast("double").alias("score"), is_pos.alias("y"))
            .groupBy(*keys, "score")
            .agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg")))


def _curve(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Running counts from the highest score down, plus the totals P and N
    (per key: a small per-key table joined on the key; no key: two scalars)."""
    k = list(keys)
    c = running_sum(counts, "score", ["pos", "neg"], part_cols=k, descending=True)
    if k:
        tot = counts.groupBy(*k).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        return c.join(tot, on=k)
    t = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return c.withColumns({n: F.lit(int(t[n] or 0)).cast("bigint") for n in ("P", "N")})


def running_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, score, pos, neg`` -> with ``cum_pos, cum_neg`` from the highest score down and the totals ``P, N``."""
    return _curve(counts, keys)


def class_counts(scored: DataFrame, classes: Sequence[str], actual: str = "actual", keys: Sequence[str] = ()) -> DataFrame:
    """``keys, cls, score, pos, neg``: every class against the rest, by its own score, in one grouped pass."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("cls"), qcol(c).cast("double").alias("score"))
                               for c in classes]))
    k = list(keys)
    long = scored.select(*k, F.col(actual).cast("string").alias("actual"), pairs)
    return (long.groupBy(*k, "cls", "score").agg(
        F.sum((F.col("actual") == F.col("cls")).cast("bigint")).alias("pos"),
        F.sum((F.col("actual") != F.col("cls")).cast("bigint")).alias("neg")))


def roc_points(c: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return c.select(*keys, F.col("score").alias("threshold"), _ratio(F.col("cum_neg"), F.col("N")).alias("fpr"),
                    _ratio(F.col("cum_pos"), F.col("P")).alias("tpr"),
                    F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"))


def pr_points(c: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return c.select(*keys, F.col("score").alias("threshold"),
                    _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                    _ratio(F.col("cum_pos"), F.col("P")).alias("recall"))


def auc_of(c: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Area per key from running counts: negatives strictly below a score are N less those at or above it."""
    contrib = F.col("pos") * (F.col("N") - F.col("cum_neg") + F.col("neg") / 2.0)
    return c.groupBy(*keys).agg(_ratio(F.sum(contrib), F.max("P").cast("double") * F.max("N")).alias("auc"))


def roc_curve(scored: DataFrame, positive: str, score_col: str, actual: str = "actual",
              keys: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score: threshold, fpr, tpr, tps, fps."""
    return roc_points(_curve(score_counts(scored, positive, score_col, actual, keys), keys), keys)


def pr_curve(scored: DataFrame, positive: str, score_col: str, actual: str = "actual",
             keys: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score: threshold, precision, recall."""
    return pr_points(_curve(score_counts(scored, positive, score_col, actual, keys), keys), keys)


def corners(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Running counts (see :func:`running_counts`) of the points a ROC curve needs: the first, the last, and
    every one whose step in positives and negatives differs from the next point's step. Straight runs of
    equal steps keep their ends only."""
    c = staged(running_counts(counts, keys), "curve")
    n = next_values(c, "score", ["pos", "neg"], keys, descending=True)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    bend = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    return n.where(first | bend).drop("next_pos", "next_neg")


def roc_corners(scored: DataFrame, positive: str, score_col: str, actual: str = "actual",
                keys: Sequence[str] = ()) -> DataFrame:
    """E10 without collinear points, and with the point (0, 0), where no row is called positive: its
    threshold is null. No rows, no points."""
    counts = staged(score_counts(scored, positive, score_col, actual, keys), "curve-counts")
    points = roc_points(corners(counts, keys), keys)
    none = counts.select(*keys).distinct() if keys else counts.limit(1).select()
    start = none.select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                        F.lit(0.0).alias("tpr"), F.lit(0).cast("bigint").alias("tps"), F.lit(0).cast("bigint").alias("fps"))
    return points.unionByName(start)


def pr_curve_closed(scored: DataFrame, positive: str, score_col: str, actual: str = "actual",
                    keys: Sequence[str] = ()) -> DataFrame:
    """E13 with its end point: precision 1 and recall 0, without a threshold. No rows, no points."""
    counts = staged(score_counts(scored, positive, score_col, actual, keys), "curve-counts")
    none = counts.select(*keys).distinct() if keys else counts.limit(1).select()
    end = none.select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                      F.lit(0.0).alias("recall"))
    return pr_points(running_counts(counts, keys), keys).unionByName(end)


def _auc_from_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return auc_of(_curve(counts, list(keys)), list(keys))


def roc_auc(scored: DataFrame, positive: str, score_col: str, actual: str = "actual") -> DataFrame:
    """Binary AUC from scores."""
    return _auc_from_counts(score_counts(scored, positive, score_col, actual))


def roc_auc_macro(scored: DataFrame, classes: Sequence[str], actual: str = "actual",
                  keys: Sequence[str] = ()) -> DataFrame:
    """E12 (per ``keys``): mean over classes of the one-vs-rest AUC of each class's own score.

    Scores are unpivoted to (class, score, is_positive) and all
    classes are done in one grouped pass.
    """
    k = list(keys)
    counts = class_counts(scored, classes, actual, k)
    per = _auc_from_counts(counts, keys=[*k, "cls"])
    return per.groupBy(*k).agg(F.avg("auc").alias("auc_macro"))


def roc_auc_hard(cm: DataFrame, positive: str, keys: Sequence[str] = ()) -> DataFrame:
    """E11b (per ``keys``): AUC of hard labels = (TPR + TNR) / 2 from the confusion counts."""
    a = F.col("actual") == F.lit(positive)
    p = F.col("pred") == F.lit(positive)
    agg = cm.groupBy(*keys).agg(
        F.sum(F.when(a & p, F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(a, F.col("n")).otherwise(0)).alias("P"),
        F.sum(F.when(~a & ~p, F.col("n")).otherwise(0)).alias("tn"), F.sum(F.when(~a, F.col("n")).otherwise(0)).alias("N"))
    return agg.select(*keys, ((_ratio(F.col("tp"), F.col("P")) + _ratio(F.col("tn"), F.col("N"))) / 2).alias("auc_hard"))
