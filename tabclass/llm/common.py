"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut, and
    a lost executor never makes an earlier step run again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, one for each of ``names``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def text_bytes(docs: DataFrame, col: str) -> int:
    """Bytes of all texts (one column scan)."""
    n = docs.agg(F.sum(F.octet_length(F.col(col).cast("string")))).first()[0]
    return int(n or 0)


def parts_for(spark: SparkSession, size: int, target: int) -> int:
    """Partitions of about ``target`` bytes, at least the session's shuffle
    partitions; it grows with the data and has no ceiling."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / target), 1)
