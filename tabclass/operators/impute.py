"""Most frequent values (A7) and mode imputation (M9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mode_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mode, count) per numeric column; ties -> smallest value.

    Values are unpivoted and counted with one partial aggregate; the winner per
    feature is a ``max_by`` over (count, -value) — no collect of a column's
    values into one buffer, however many distinct values there are.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("v"))
                               for c in cols]))
    counts = (df.select(pairs).where(F.col("v").isNotNull())
              .groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c")))
    best = counts.groupBy("feature").agg(
        F.max_by(F.struct("v", "c"), F.struct(F.col("c"), (-F.col("v")).alias("nv"))).alias("b"))
    return best.select("feature", F.col("b.v").alias("mode"), F.col("b.c").alias("count"))


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Modes of the train part (one value per feature, kept with the model, Q9)."""
    return {r["feature"]: r["mode"] for r in mode_values(train, cols).collect()}


def impute_mode(df: DataFrame, modes: dict[str, float]) -> DataFrame:
    """M9: nulls replaced by the fitted modes."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v))
                           for c, v in modes.items() if c in df.columns})
