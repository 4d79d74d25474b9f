"""Text <-> structure helpers (feature lists, parameter JSON, combo names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TS_FORMAT


def parse_feature_list(text: Column) -> Column:
    """X1: "['a', 'b']" (a stringified Python list) -> array<string>."""
    return F.from_json(F.translate(text, "'", '"'), "array<string>")


def format_feature_list(arr: Column) -> Column:
    """array<string> -> "['a', 'b']" (the stored legacy text form)."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def parse_params(text: Column) -> Column:
    """Parameter JSON text -> map<string,string>."""
    return F.from_json(text, "map<string,string>")


def params_to_json(m: Column) -> Column:
    return F.to_json(m)


def combo_model(combo: Column) -> Column:
    """X4: '<model>_<sampling>' -> model."""
    return F.split(combo, "_").getItem(0)


def combo_sampling(combo: Column) -> Column:
    """X4: '<model>_<sampling>' -> sampling."""
    return F.split(combo, "_").getItem(1)


def split_list(text: Column, lower: bool = True) -> Column:
    """X5: 'a, B ,c' -> ['a','b','c'] (trimmed; lower-cased when asked)."""
    parts = F.split(text, ",")
    return F.transform(parts, lambda x: F.lower(F.trim(x)) if lower else F.trim(x))


def format_ts(ts: Column) -> Column:
    """Timestamp -> 'dd/MM/yyyy HH:mm:ss' text."""
    return F.date_format(ts, TS_FORMAT)
