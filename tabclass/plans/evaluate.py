"""Evaluation of one fitted model on its train, validation and test rows.

The sets' predictions are written once; two passes read them: the confusion counts, which give
all label metrics and distributions, and the sorted chunks of scores (:mod:`.score_chunks`), whose running
counts give areas and curves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import curves, describe, metrics, score_chunks

# Metric name after the set's prefix -> column of the keyed summary
METRICS = {"recall": "focus_recall", "precision": "focus_precision", "f1": "focus_f1", "f_beta": "focus_fbeta",
           "auc": "auc", "overall_recall": "recall", "overall_precision": "precision", "overall_f1": "f1",
           "overall_fbeta": "fbeta", "accuracy": "accuracy"}


def tagged(sets: dict[str, DataFrame]) -> DataFrame:
    """The sets in one frame, told apart by ``set``."""
    out = None
    for name, d in sets.items():
        t = d.withColumn("set", F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


def metrics_long(cm: DataFrame, auc: DataFrame, focus: Sequence[str], beta: float, digits: int = 3) -> DataFrame:
    """``Metric`` (``<set>_<name>``), ``Value``: ten rows per set, from the
    keyed confusion counts and the keyed areas (``set, auc``)."""
    s = metrics.summary(cm, keys=["set"], beta=beta, focus=focus).join(auc, "set", "left")
    pairs = F.inline(F.array(*[F.struct(F.concat("set", F.lit(f"_{n}")).alias("Metric"),
                                        (F.round("auc", 2) if c == "auc" else F.col(c)).cast("double").alias("Value"))
                               for n, c in METRICS.items()]))
    return s.select(pairs).withColumn("Value", F.round("Value", digits))


def evaluate(sets: dict[str, DataFrame], classes: Sequence[str], focus: Sequence[str], beta: float) -> dict[str, DataFrame]:
    """Tables by name: report, confusion, confusion_norm, metrics, auc_hard,
    roc, pr, distribution. Each set has ``actual``, ``pred`` and one score
    column per class."""
    rows = staged(tagged({k: v.select(F.col("actual").cast("string"), F.col("pred").cast("string"),
                                      *[F.col(f"`{c}`") for c in classes]) for k, v in sets.items()}), "scored-sets")
    cm = staged(metrics.confusion_counts(rows, keys=["set"]), "confusion")  # sets x classes^2 rows
    sizes = {r["set"]: r["n"] for r in cm.groupBy("set").agg(F.sum("n").alias("n")).collect()}  # a row a set
    first = focus[0]
    running = staged(score_chunks.running_points(rows, classes, sizes, first), "running-counts")
    auc = (running.where("pos IS NULL").groupBy("set", "cls")
           .agg(metrics._ratio(F.sum("area"), F.max("P").cast("double") * F.max("N")).alias("auc"))
           .groupBy("set").agg(F.avg("auc").alias("auc")))
    of_first = running.where((F.col("cls") == first) & F.col("pos").isNotNull())
    return {
        "report": metrics.classification_report(cm, keys=["set"]),
        "confusion": metrics.dense_confusion(cm, keys=["set"]),
        "confusion_norm": metrics.normalized_confusion(cm, keys=["set"]),
        "metrics": metrics_long(cm, auc, focus, beta),
        "auc_hard": curves.roc_auc_hard(cm, first, keys=["set"]),
        "roc": curves.roc_points(of_first, ["set"]),
        "pr": curves.pr_points(of_first, ["set"]),
        "distribution": describe.distribution_from_counts(cm),
    }
