"""Projections and schema operators (P1-P10). All narrow: no shuffle."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import ABSENT_ACTUAL, MISSING_TARGET
from ..functions.rowwise import qcol


def with_actual(df: DataFrame, target: str) -> DataFrame:
    """Keep the true label as ``<target>_actual`` ('NA' when absent, Q2)."""
    val = qcol(target).cast("string") if target in df.columns else F.lit(ABSENT_ACTUAL)
    return df.withColumn(f"{target}_actual", val)


def prep_target(df: DataFrame, target: str) -> DataFrame:
    """Target as text; a missing value becomes the label 'nan' (Q1)."""
    return df.withColumn(target, F.coalesce(qcol(target).cast("string"), F.lit(MISSING_TARGET)))


def prep_columns(df: DataFrame, id_col: str, target: str | None,
                 like: DataFrame | None = None) -> DataFrame:
    """Canonical ``id``, features..., ``target`` (string) in that order.

    ``id_col == 'id'`` and an absent target (score-only tables) are allowed
    (Q13, Q2). With ``like`` the feature columns are taken from that frame
    (the prediction table is cut to the history's columns).
    """
    d = df
    if target is not None and target in d.columns:
        d = prep_target(d, target)
        if target != "target":
            d = d.drop("target").withColumnRenamed(target, "target")
    if id_col != "id":
        d = d.drop("id").withColumnRenamed(id_col, "id")
    ref = like.columns if like is not None else d.columns
    feats = [c for c in ref if c not in ("id", "target")]
    cols = ["id"] + feats + (["target"] if "target" in d.columns else [])
    return d.select(*[qcol(c) for c in cols])


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """P5: drop the named columns that exist (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("id", "target")) -> list[str]:
    """The feature list = columns minus id / target / helper columns."""
    return [c for c in df.columns if c not in exclude]


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("id",),
                   fill: float = 0.0) -> DataFrame:
    """Select the stored features in stored order; absent ones become ``fill``."""
    out = [qcol(c) for c in keep if c in df.columns]
    for c in features:
        out.append(qcol(c) if c in df.columns else F.lit(fill).alias(c))
    return df.select(*out)


def tag(df: DataFrame, **values) -> DataFrame:
    """Literal columns (model_name, sampling_type, model_id, ...)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def safe_names(df: DataFrame, prefix: str = "pred_") -> DataFrame:
    """Prefix digit-leading column names (class names used as columns)."""
    return df.toDF(*[prefix + c if re.match(r"^\d", c) else c for c in df.columns])


def cast_like(df: DataFrame, schema: StructType) -> DataFrame:
    """P10: cast columns to the types of ``schema`` (same names)."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[qcol(c).cast(types[c]).alias(c) if c in types else qcol(c) for c in df.columns])


def round_cols(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    """Round the given columns."""
    return df.withColumns({c: F.round(qcol(c), digits) for c in cols})
