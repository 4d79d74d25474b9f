"""Stratified train/validation split (M1) and stratified k-fold labels (M8).

Both are columns added to the one training frame (``split``, ``fold``), so no
data is copied per fold or per trial. Both cut a class at a few ranks, so only the
buckets of rows around a cut are ranked (:func:`tabclass.functions.ranking.rank_steps`):
the table is scanned, not shuffled.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SPLIT_SEED, VALIDATION_SHARE
from ..functions.hashing import hash32, hash_bucket
from ..functions.ranking import hash_bits_for, rank_steps


def _class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("__n"))


def stratified_split(df: DataFrame, target: str = "target", id_col: str = "id",
                     share: float = VALIDATION_SHARE, seed: int = SPLIT_SEED,
                     out: str = "split") -> DataFrame:
    """Per class, the ``floor(share * n_c + 0.5)`` rows with the smallest
    ``md5('<seed>:<id>')`` draw are 'validation', the rest 'train'. Class
    shares are kept within one row; a class with >= 2 rows is on both sides."""
    counts = _class_counts(df, target).persist()
    top = counts.agg(F.max("__n")).first()[0] or 0
    h = hash32(seed, F.col(id_col))
    n_val = F.floor(F.col("__n") * F.lit(float(share)) + F.lit(0.5))
    d = rank_steps(df.withColumn("__h", h), target, ["__h", id_col], counts.select(target, F.array(n_val).alias("cuts")),
                   out="__s", bucket=hash_bucket(F.col("__h"), hash_bits_for(top)))
    counts.unpersist()
    return d.withColumn(out, F.when(F.col("__s") == 0, "validation").otherwise("train")).drop("__h", "__s")


def fold_quotas(class_rows: list[tuple[str, int, object]], k: int) -> dict[str, list[int]]:
    """Cumulative per-fold quotas per class, as scikit-learn's StratifiedKFold
    (no shuffle) allocates them: classes are ordered by first appearance, the
    sorted label vector is dealt round-robin to the k folds, and each class's
    rows (in order) fill folds 0..k-1 contiguously.

    ``class_rows``: (label, count, first_position_key). Bounded by the class count.
    """
    rows = sorted(class_rows, key=lambda r: r[2])
    out, start = {}, 0

    def upto(x: int, f: int) -> int:  # positions p in [0, x) with p % k == f
        return (x - f + k - 1) // k if x > 0 else 0

    for label, n, _ in rows:
        cum, acc = [], 0
        for f in range(k):
            acc += upto(start + n, f) - upto(start, f)
            cum.append(acc)
        out[label] = cum
        start += n
    return out


def stratified_kfold(df: DataFrame, k: int, target: str = "target", id_col: str = "id",
                     out: str = "fold", n_buckets: int | None = None) -> DataFrame:
    """M8: fold 0..k-1 per row; within a class rows are taken in id order."""
    stats = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first"))
    rows = [(r[target], int(r["n"]), r["first"]) for r in stats.collect()]  # one row per class
    if rows and all(n < k for _, n, _ in rows):
        raise ValueError(f"k={k} folds cannot be greater than the number of rows in each class")
    small = [lab for lab, n, _ in rows if n < k]
    if small:
        logging.getLogger(__name__).warning("classes with fewer than k=%d rows: %s", k, small[:10])
    quotas = fold_quotas(rows, k)
    spark = df.sparkSession
    qdf = spark.createDataFrame(list(quotas.items()), f"`{target}` string, cuts array<long>")  # classes x k numbers
    return rank_steps(df, target, [id_col], qdf, out=out, n_buckets=n_buckets)
