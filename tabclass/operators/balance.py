"""Class balance (A1, A1b, A2, A3, A8) — partial aggregates, tiny outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import IMBALANCE_LIMIT


def _with_total(vc: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Attach the per-key total of ``col`` (the count table is one row per
    class): per key an equi-join of two small tables; without keys a scalar."""
    if keys:
        tot = vc.groupBy(*keys).agg(F.sum(col).alias(out))
        return vc.join(tot, keys)
    t = vc.agg(F.sum(col).alias(out)).first()[out]
    return vc.withColumn(out, F.lit(int(t or 0)).cast("bigint"))


def value_counts(df: DataFrame, col: str, dropna: bool = True, keys=()) -> DataFrame:
    """(keys, value, count, share, pct); nulls kept as a group unless
    ``dropna``. The total comes from the count table (one row per class)."""
    k = list(keys)
    d = df.where(F.col(col).isNotNull()) if dropna else df
    vc = d.groupBy(*k, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    vc = _with_total(vc, k, "count", "__t")
    return (vc.withColumn("share", F.col("count") / F.col("__t"))
            .withColumn("pct", F.col("count") * 100.0 / F.col("__t")).drop("__t"))


def class_list(df: DataFrame, col: str = "target") -> DataFrame:
    """A2: (label, count, n_labels) — distinct labels with counts."""
    vc = (df.groupBy(F.col(col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
          .withColumn("__one", F.lit(1)))
    return _with_total(vc, [], "__one", "n_labels").drop("__one")


def class_imbalance(df: DataFrame, col: str = "target", limit: float = IMBALANCE_LIMIT) -> DataFrame:
    """A3: extent = round(min count / max count, 4); imbalanced when < limit."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("c"))
    return (vc.agg(F.min("c").alias("min_count"), F.max("c").alias("max_count"),
                   F.count(F.lit(1)).alias("n_classes"))
            .withColumn("extent", F.round(F.col("min_count") / F.col("max_count"), 4))
            .withColumn("imbalanced", F.col("extent") < F.lit(limit)))


def split_shapes(df: DataFrame, split_col: str = "split", exclude=("split", "target")) -> DataFrame:
    """Rows and columns of each part of a split (target and split not counted)."""
    n_cols = len([c for c in df.columns if c not in exclude])
    return (df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("columns", F.lit(n_cols).cast("bigint")))
