"""Label encoding (M2) and one-hot binarising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import UNKNOWN_LABEL


def fit_label_encoder(df: DataFrame, col: str = "target", out: str = "label") -> StringIndexerModel:
    """Sorted distinct labels -> 0..n-1; unseen (and null) -> n at transform time.

    The label counts are one distributed aggregate; only the label list
    (bounded by the class count) reaches the driver.
    """
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="keep").fit(df)


def labels_of(model: StringIndexerModel) -> list[str]:
    return list(model.labels)


def decode(df: DataFrame, model: StringIndexerModel, col: str = "prediction",
           out: str = "pred") -> DataFrame:
    """Inverse map; index n decodes to '<unknown>'."""
    labels = labels_of(model) + [UNKNOWN_LABEL]
    return IndexToString(inputCol=col, outputCol=out, labels=labels).transform(df)


def label_binarize(df: DataFrame, col: str, classes: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """One 0/1 int column per class."""
    return df.select(*[c for c in keep if c in df.columns],
                     *[(F.col(col) == F.lit(c)).cast("int").alias(c) for c in classes])
