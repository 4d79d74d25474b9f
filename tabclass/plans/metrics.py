"""Evaluation from one confusion-count aggregate.

The scored frame is read once: ``groupBy(keys, actual, pred).count()`` is a
partially aggregated pass whose output has at most keys x classes^2 rows.
Every metric below is computed from that small table, so adding metrics never
re-reads the data. Undefined ratios are 0 (the scikit-learn convention).

Labels of a report are the classes seen as actual or predicted (sorted), as in
scikit-learn's ``classification_report``; focus metrics use exactly the focus
labels, present or not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLS = ("value", "precision", "recall", "f1_score", "support")


def _k(keys) -> list[str]:
    return list(keys or [])


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion_counts(scored: DataFrame, actual: str = "actual", pred: str = "pred",
                     keys: Sequence[str] = ()) -> DataFrame:
    """A9 (long form): (keys, actual, pred, n)."""
    return (scored.groupBy(*_k(keys), F.col(actual).cast("string").alias("actual"),
                           F.col(pred).cast("string").alias("pred"))
            .agg(F.count(F.lit(1)).alias("n")))


def _label_frame(cm: DataFrame, keys: list[str], labels: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.lit(x) for x in labels])
    base = cm.select(*keys).distinct() if keys else cm.sparkSession.range(1).select()
    return base.select(*keys, F.explode(arr).alias("label"))


def fbeta(p: Column, r: Column, beta: float) -> Column:
    b2 = float(beta) ** 2
    return _ratio((1 + b2) * p * r, b2 * p + r)


def per_class(cm: DataFrame, keys: Sequence[str] = (), labels: Sequence[str] | None = None,
              beta: float | None = None) -> DataFrame:
    """(keys, label, tp, support, predicted, precision, recall, f1[, fbeta]).

    ``labels`` None: the labels seen in ``cm`` (actual or predicted); otherwise
    exactly ``labels`` (absent ones get zeros).
    """
    k = _k(keys)
    same = F.col("actual") == F.col("pred")
    zero = F.lit(0).cast("bigint")
    contrib = cm.select(*k, F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 F.when(same, F.col("n")).otherwise(zero).alias("tp"),
                 F.when(same, F.col("n")).otherwise(zero).alias("predicted")),
        F.struct(F.col("pred").alias("label"), zero.alias("support"), zero.alias("tp"),
                 F.when(~same, F.col("n")).otherwise(zero).alias("predicted")),
    )).alias("c")).select(*k, "c.*")
    pc = contrib.groupBy(*k, "label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                          F.sum("predicted").alias("predicted"))
    if labels is not None:
        pc = (_label_frame(cm, k, labels).join(pc, on=k + ["label"], how="left")
              .na.fill(0, ["tp", "support", "predicted"]))
    p = _ratio(F.col("tp"), F.col("predicted"))
    r = _ratio(F.col("tp"), F.col("support"))
    pc = pc.withColumn("precision", p).withColumn("recall", r)
    pc = pc.withColumn("f1", fbeta(F.col("precision"), F.col("recall"), 1.0))
    if beta is not None:
        pc = pc.withColumn("fbeta", fbeta(F.col("precision"), F.col("recall"), beta))
    return pc


def summary(cm: DataFrame, keys: Sequence[str] = (), labels: Sequence[str] | None = None,
            beta: float = 1.0, focus: Sequence[str] | None = None) -> DataFrame:
    """One row per key: accuracy (over all rows), macro and support-weighted
    precision / recall / F1 / F-beta over ``labels`` (None = all seen); with
    ``focus`` also the same metrics over the focus labels as ``focus_*``.

    One conditional aggregate over the per-class table (no joins): focus
    labels that never occur contribute zeros through the fixed divisor."""
    k = _k(keys)
    pc = per_class(cm, k, None, beta)

    def block(lab, prefix):
        if lab is None:
            sel, n_lab = F.lit(True), F.count(F.lit(1))
        else:
            sel, n_lab = F.col("label").isin(list(lab)), F.lit(float(len(set(lab))))
        on = lambda c: F.sum(F.when(sel, F.col(c)).otherwise(F.lit(0.0)))
        sw = F.sum(F.when(sel, F.col("support")).otherwise(F.lit(0)))
        wsum = lambda c: F.sum(F.when(sel, F.col(c) * F.col("support")).otherwise(F.lit(0.0)))
        return [(on("precision") / n_lab).alias(f"{prefix}precision"),
                (on("recall") / n_lab).alias(f"{prefix}recall"),
                (on("f1") / n_lab).alias(f"{prefix}f1"), (on("fbeta") / n_lab).alias(f"{prefix}fbeta"),
                _ratio(wsum("precision"), sw).alias(f"{prefix}weighted_precision"),
                _ratio(wsum("recall"), sw).alias(f"{prefix}weighted_recall"),
                _ratio(wsum("f1"), sw).alias(f"{prefix}weighted_f1"),
                sw.alias(f"{prefix}support")]

    cols = [_ratio(F.sum("tp"), F.sum("support")).alias("accuracy")] + block(labels, "")
    if focus is not None:
        cols += block(focus, "focus_")
    return pc.groupBy(*k).agg(*cols)


def classification_report(cm: DataFrame, keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Per-class rows, then ``accuracy`` (accuracy in all four columns),
    ``macro avg`` and ``weighted avg``; columns value, precision, recall,
    f1_score, support (double), rounded to ``digits``."""
    k = _k(keys)
    pc = per_class(cm, k)
    rnd = lambda c: F.round(c.cast("double"), digits)
    rows = pc.select(*k, F.col("label").alias("value"), rnd(F.col("precision")).alias("precision"),
                     rnd(F.col("recall")).alias("recall"), rnd(F.col("f1")).alias("f1_score"),
                     rnd(F.col("support")).alias("support"))
    sw = F.sum("support")
    tot = pc.groupBy(*k).agg(
        _ratio(F.sum("tp"), sw).alias("acc"), sw.cast("double").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _ratio(F.sum(F.col("precision") * F.col("support")), sw).alias("wp"),
        _ratio(F.sum(F.col("recall") * F.col("support")), sw).alias("wr"),
        _ratio(F.sum(F.col("f1") * F.col("support")), sw).alias("wf"))
    three = tot.select(*k, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("value"), F.col("acc").alias("precision"),
                 F.col("acc").alias("recall"), F.col("acc").alias("f1_score"),
                 F.col("acc").alias("support")),
        F.struct(F.lit("macro avg").alias("value"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("value"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support")),
    )).alias("r")).select(*k, F.col("r.value").alias("value"),
                          *[rnd(F.col(f"r.{c}")).alias(c) for c in REPORT_COLS[1:]])
    return rows.unionByName(three)


def dense_confusion(cm: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A9 dense: every (actual, pred) pair over the seen labels, zeros filled.

    Labels are collected (bounded by the class count) and the grid is built
    from a literal array, so no join of data-sized frames is involved.
    """
    k = _k(keys)
    labels = sorted({r[0] for r in cm.select("actual").union(cm.select("pred")).distinct().collect()})
    grid = (_label_frame(cm, k, labels).withColumnRenamed("label", "actual")
            .withColumn("pred", F.explode(F.array(*[F.lit(x) for x in labels]))))
    return (grid.join(cm, on=k + ["actual", "pred"], how="left")
            .select(*k, "actual", "pred", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def normalized_confusion(cm: DataFrame, keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """A10: counts divided by the actual label's total (rows sum to 1)."""
    k = _k(keys)
    d = dense_confusion(cm, k)
    tot = d.groupBy(*k, "actual").agg(F.sum("n").alias("t"))
    return (d.join(tot, on=k + ["actual"]).select(
        *k, "actual", "pred", F.round(_ratio(F.col("n"), F.col("t")), digits).alias("share")))


def metric_table(rows: dict[str, Column], df: DataFrame, digits: int = 3) -> DataFrame:
    """Long (Metric, Value) table from one-row metric columns."""
    names = list(rows)
    one = df.select(*[rows[n].cast("double").alias(f"m{i}") for i, n in enumerate(names)])
    long = F.inline(F.array(*[F.struct(F.lit(n).alias("Metric"), F.col(f"m{i}").alias("Value"))
                              for i, n in enumerate(names)]))
    return one.select(long).withColumn("Value", F.round("Value", digits))


def validation_table(preds_by_combo: dict, focus, beta: float):
    """One row per combo with focus and overall metrics on validation.

    All combos' predictions are tagged and unioned, so every combo's metrics
    come from one keyed aggregate (no job per combo, no join)."""
    tagged = None
    for combo, p in preds_by_combo.items():
        t = p.select(F.lit(combo).alias("model_name"), F.col("target").cast("string").alias("actual"),
                     F.col("pred").cast("string").alias("pred"))
        tagged = t if tagged is None else tagged.unionByName(t)
    s = summary(confusion_counts(tagged, keys=["model_name"]), keys=["model_name"], beta=beta, focus=focus)
    return s.select(
        "model_name",
        F.col("focus_recall").alias("recall"), F.col("focus_precision").alias("precision"),
        F.col("focus_f1").alias("f1"), F.col("focus_fbeta").alias("f_beta"),
        F.col("recall").alias("overall_recall"), F.col("precision").alias("overall_precision"),
        F.col("f1").alias("overall_f1"), F.col("fbeta").alias("overall_fbeta"), "accuracy")


def score_from_counts(rows, beta: float = 1.0, accuracy: bool = False) -> float:
    """CV scorer on collected confusion counts ``(actual, pred, n)`` — a
    classes^2-sized list: accuracy, or macro F-beta over the labels seen (the
    T3 rule: precision focus -> F0.5, recall -> F2, otherwise F1)."""
    tot = sum(n for _, _, n in rows)
    if accuracy:
        return sum(n for a, p, n in rows if a == p) / tot if tot else 0.0
    labels = {a for a, _, _ in rows} | {p for _, p, _ in rows}
    b2 = float(beta) ** 2
    vals = []
    for c in labels:
        tp = sum(n for a, p, n in rows if a == c and p == c)
        sup = sum(n for a, _, n in rows if a == c)
        prd = sum(n for _, p, n in rows if p == c)
        pr = tp / prd if prd else 0.0
        rc = tp / sup if sup else 0.0
        den = b2 * pr + rc
        vals.append((1 + b2) * pr * rc / den if den > 0 else 0.0)
    return sum(vals) / len(vals) if vals else 0.0

