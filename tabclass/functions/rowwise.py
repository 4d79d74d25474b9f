"""Row-wise operators over a fixed set of columns (class scores, model votes)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """Column by name, safe for dots, spaces and leading digits."""
    return F.col(f"`{name}`")


def argmax_class(score_cols: Sequence[str], labels: Sequence[str] | None = None) -> Column:
    """Name of the largest score column; the first maximum wins.

    ``labels`` (default: the column names) are returned in place of the names.
    """
    labels = list(labels) if labels is not None else list(score_cols)
    arr = F.array(*[qcol(c).cast("double") for c in score_cols])
    pos = F.array_position(arr, F.array_max(arr))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), pos.cast("int"))


def ensemble_max(pred_cols: Sequence[str]) -> Column:
    """Row-wise maximum of encoded predictions."""
    return F.greatest(*[qcol(c) for c in pred_cols])


def ensemble_vote(df: DataFrame, id_col: str, pred_cols: Sequence[str],
                  out: str = "vote") -> DataFrame:
    """Majority vote over model predictions per row; ties -> smallest label.

    Row-local: the votes are an array in the row, counted with higher-order
    functions, so no shuffle and no explode is needed.
    """
    arr = F.array(*[qcol(c) for c in pred_cols])
    counted = F.transform(F.array_distinct(arr), lambda v: F.struct(
        (-F.size(F.filter(arr, lambda x: x == v))).alias("neg"), v.alias("v")))
    best = F.array_min(counted)
    return df.withColumn(out, best.getField("v"))


def lookup_small(df: DataFrame, small: DataFrame, keys: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """Attach ``values`` of a keyed table (one row per class, group, ...) to
    ``df``; rows whose key is missing get nulls.

    The table is written to the shared folder first, so the planner knows its
    size: a plain left join that it broadcasts below the session's threshold
    and shuffles above, where adaptive execution may split a hot key. The same
    join, and the same rows, at every size."""
    from ..session import staged

    keys = [keys] if isinstance(keys, str) else list(keys)
    own = [f"__lookup_{i}" for i in range(len(keys))]
    t = staged(small.select(*[qcol(k).alias(o) for k, o in zip(keys, own)], *[qcol(v) for v in values]), "lookup")
    on = [qcol(k) == F.col(o) for k, o in zip(keys, own)]
    return df.join(t, on, "left").drop(*own)
