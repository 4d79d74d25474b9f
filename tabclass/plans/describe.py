"""Describe tables (A6, E17) and side-by-side target distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import grouped_exact_quantiles
from ..functions.rowwise import lookup_small

STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def describe(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """One row per statistic (and per ``by`` value), one column per
    feature: count, mean, sample std, min, exact 25/50/75% (linear), max.

    Moments come from one aggregate; the quartiles of every (group, feature)
    come from one grouped exact-quantile run over the unpivoted features.
    """
    cols = list(cols)
    g = [by] if by else []
    agg = df.groupBy(*g).agg(*[e for c in cols for e in (
        F.count(F.col(f"`{c}`")).cast("double").alias(f"count|{c}"),
        F.avg(F.col(f"`{c}`")).alias(f"mean|{c}"),
        F.stddev_samp(F.col(f"`{c}`")).alias(f"std|{c}"),
        F.min(F.col(f"`{c}`")).cast("double").alias(f"min|{c}"),
        F.max(F.col(f"`{c}`")).cast("double").alias(f"max|{c}"))]).collect()  # one row per group
    number, d = F.lit(0), df  # group and feature as one number: i * features + j
    if by:
        keys = [(r[by], i) for i, r in enumerate(agg) if r[by] is not None]
        d = lookup_small(df, df.sparkSession.createDataFrame(keys, f"`{by}` {df.schema[by].dataType.simpleString()}, __n int"),
                         by, ["__n"]).where("__n IS NOT NULL")
        number = F.col("__n")
    long = d.select(F.inline(F.array(*[F.struct((number * len(cols) + j).alias("__g"), F.col(f"`{c}`").cast("double").alias("v"))
                                       for j, c in enumerate(cols)])))
    qs = grouped_exact_quantiles(long, "__g", "v", (0.25, 0.5, 0.75))
    rows = []
    for i, r in enumerate(agg):
        gv = r[by] if by else None
        for s in STATS:
            vals = []
            for j, c in enumerate(cols):
                if s in ("25%", "50%", "75%"):
                    q = qs.get(i * len(cols) + j) if gv is not None or not by else None
                    vals.append(None if q is None else q[("25%", "50%", "75%").index(s)])
                else:
                    x = r[f"{s}|{c}"]
                    vals.append(None if x is None else float(x))
            rows.append(((gv,) if by else ()) + (s,) + tuple(vals))
    schema = ([f"`{by}` string"] if by else []) + ["statistic string"] + [f"`{c}` double" for c in cols]
    out = df.sparkSession.createDataFrame(rows, ", ".join(schema))  # stats x groups x features
    return out


def distribution_compare(df: DataFrame, set_col: str, label_col: str) -> DataFrame:
    """Label counts and shares per set (train / validation / test, actual /
    predicted) in one grouped pass over a unioned frame."""
    vc = df.groupBy(set_col, F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    tot = vc.groupBy(set_col).agg(F.sum("count").alias("__t"))
    return vc.join(tot, set_col).withColumn("share", F.col("count") / F.col("__t")).drop("__t")


def distribution_from_counts(cm: DataFrame, set_col: str = "set") -> DataFrame:
    """E16 from keyed confusion counts: labels of each set, actual and predicted
    (``<set> actual``, ``<set> predicted``), without another pass over rows."""
    both = F.inline(F.array(*[F.struct(F.concat_ws(" ", set_col, F.lit(kind)).alias(set_col), F.col(c).alias("label"),
                                       F.col("n").alias("n")) for kind, c in (("actual", "actual"), ("predicted", "pred"))]))
    vc = cm.select(both).groupBy(set_col, "label").agg(F.sum("n").alias("count"))
    tot = vc.groupBy(set_col).agg(F.sum("count").alias("__t"))
    return vc.join(tot, set_col).withColumn("share", F.col("count") / F.col("__t")).drop("__t")
