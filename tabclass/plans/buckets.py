"""Score-percentile buckets (E7, E8, E9) in one pass over the scored rows.

For cuts q_1..q_m the thresholds t_q = quantile(score, q) come from
:func:`exact_quantiles` (m numbers, collected). A row with score s belongs to
the bucket of every cut with s >= t_q; because thresholds grow with q, that set
is "all cuts up to some level", so each row only needs its level
(= number of thresholds <= s, a sum of m literal comparisons in codegen).
``groupBy(level, actual, pred).count()`` then has at most (m+1) x classes^2 rows,
and the cumulative confusion counts per cut come from that small table.
Cost: O(rows), not O(rows x cuts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BREAKDOWN_CUTS, PRECISION_BUCKET_CUTS
from ..functions.quantiles import exact_quantiles, grouped_exact_quantiles
from ..functions.rowwise import lookup_small, qcol
from .metrics import _ratio, classification_report, per_class


def _cut_table(scored: DataFrame, score_col: str, cuts: Sequence[float], actual: str,
               pred: str | None, all_positive_label: str | None):
    """Cumulative confusion counts per cut: (cut_i, actual, pred, n) and thresholds."""
    cuts = list(cuts)
    thr = exact_quantiles(scored, score_col, cuts)
    order = sorted(range(len(cuts)), key=lambda i: (thr[i], cuts[i]))
    s = qcol(score_col).cast("double")
    level = sum((s >= F.lit(float(thr[i]))).cast("int") for i in order)
    p = F.lit(all_positive_label) if all_positive_label is not None else F.col(pred).cast("string")
    lv = (scored.select(level.alias("level"), F.col(actual).cast("string").alias("actual"),
                        p.alias("pred"))
          .groupBy("level", "actual", "pred").agg(F.count(F.lit(1)).alias("n")))
    # cut with ascending-threshold position j (1-based) holds rows with level >= j
    pos = {i: j + 1 for j, i in enumerate(order)}
    cut_of_pos = F.create_map(*[x for i in range(len(cuts)) for x in (F.lit(pos[i]), F.lit(i))])
    cm = (lv.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("level"))))
          .withColumn("cut_i", F.element_at(cut_of_pos, F.col("j")))
          .where(F.col("cut_i").isNotNull())
          .groupBy("cut_i", "actual", "pred").agg(F.sum("n").alias("n")))
    return cm, thr


def percentile_breakdown(scored: DataFrame, focus: Sequence[str], actual: str = "actual",
                         pred: str = "pred", all_positive: bool = False,
                         cuts: Sequence[float] = BREAKDOWN_CUTS) -> DataFrame:
    """Classification report of the rows whose first-focus score is at
    or above each quantile cut, tagged ``percentile = round((1 - q) * 100)``.
    E8 (``all_positive``) calls every row of a bucket the first focus label."""
    first = focus[0]
    cm, _ = _cut_table(scored, first, cuts, actual, pred, first if all_positive else None)
    rep = classification_report(cm, keys=["cut_i"])
    tag = F.create_map(*[x for i, q in enumerate(cuts)
                         for x in (F.lit(i), F.lit(int(round((1 - q) * 100))))])
    return rep.withColumn("percentile", F.element_at(tag, F.col("cut_i"))).drop("cut_i")


def percentile_breakdown_by(scored: DataFrame, key: str, focus: Sequence[str], actual: str = "actual",
                            pred: str = "pred", cuts: Sequence[float] = BREAKDOWN_CUTS) -> DataFrame:
    """:func:`percentile_breakdown` per value of ``key`` (a model id), each
    with its own thresholds; one pass for all of them."""
    cuts = list(cuts)
    thr = grouped_exact_quantiles(scored, key, focus[0], cuts)  # groups x cuts numbers
    kind = scored.schema[key].dataType.simpleString()
    table = scored.sparkSession.createDataFrame([(g, [float(x) for x in t]) for g, t in thr.items()],
                                                f"`{key}` {kind}, __thr array<double>")
    s = qcol(focus[0]).cast("double")
    hit = F.filter(F.transform("__thr", lambda t, i: F.when(s >= t, i)), lambda i: i.isNotNull())
    rows = lookup_small(scored, table, key, ["__thr"]).select(
        qcol(key), F.col(actual).cast("string").alias("actual"), F.col(pred).cast("string").alias("pred"),
        hit.alias("__hit"))
    n = rows.groupBy(key, "__hit", "actual", "pred").agg(F.count(F.lit(1)).alias("n"))  # a level per cut at most
    cm = (n.select(key, F.explode("__hit").alias("cut_i"), "actual", "pred", "n")
          .groupBy(key, "cut_i", "actual", "pred").agg(F.sum("n").alias("n")))
    tag = F.element_at(F.array(*[F.lit(int(round((1 - q) * 100))) for q in cuts]), F.col("cut_i") + 1)
    return classification_report(cm, keys=[key, "cut_i"]).withColumn("percentile", tag).drop("cut_i")


def precision_buckets(scored: DataFrame, focus: Sequence[str], actual: str = "actual",
                      pred: str = "pred", cuts: Sequence[float] = PRECISION_BUCKET_CUTS) -> DataFrame:
    """Per cut q: percentile round((1-q)*100, 1), threshold, accuracy and the
    focus-macro precision / recall / F1 (x100, 2 decimals), and the row count."""
    first = focus[0]
    cm, thr = _cut_table(scored, first, cuts, actual, pred, None)
    pc = per_class(cm, keys=["cut_i"], labels=list(focus))
    m = pc.groupBy("cut_i").agg(F.avg("precision").alias("p"), F.avg("recall").alias("r"),
                                F.avg("f1").alias("f"))
    tot = cm.groupBy("cut_i").agg(
        F.sum("n").alias("users"),
        _ratio(F.sum(F.when(F.col("actual") == F.col("pred"), F.col("n")).otherwise(0)),
               F.sum("n")).alias("a"))
    meta = cm.sparkSession.createDataFrame(
        [(i, round((1 - q) * 100, 1), float(thr[i])) for i, q in enumerate(cuts)],
        "cut_i int, percentile double, percentile_value double")
    pct = lambda c: F.round(F.col(c) * 100, 2)
    return (F.broadcast(meta).join(tot, "cut_i").join(m, "cut_i")
            .select("percentile", "percentile_value", pct("a").alias("accuracy"),
                    pct("p").alias("precision"), pct("r").alias("recall"),
                    pct("f").alias("f1_score"), F.col("users").cast("bigint").alias("users")))
