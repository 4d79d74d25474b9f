"""Scans (S1-S4): catalog / parquet / JDBC tables, missing-history fallback,
registry lookups."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException


def read_table(spark: SparkSession, name: str, sf_dir: str | None = None,
               source: str = "auto", options: dict | None = None) -> DataFrame:
    """A lazy scan; later ``select``/``where`` prune columns and push
    filters into the scan.

    source: "table" (catalog), "parquet" (``<sf_dir>/<name>.parquet``), "jdbc"
    (``options`` from :func:`jdbc_options`), or "auto" (parquet when ``sf_dir``
    is given, catalog otherwise).
    """
    if source == "jdbc":
        return spark.read.format("jdbc").options(**(options or {})).load()
    if source == "parquet" or (source == "auto" and sf_dir is not None):
        return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spark.table(name)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000, driver: str | None = None) -> dict:
    """Options for a parallel JDBC read (one range per partition).

    Without a partition column a JDBC scan is a single task, so a numeric
    ``partition_column`` with bounds is required for tables beyond a few GB.
    """
    o = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if driver:
        o["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        o.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                 upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return o


def table_exists(spark: SparkSession, name: str, sf_dir: str | None = None) -> bool:
    if sf_dir is not None:
        return os.path.exists(os.path.join(sf_dir, f"{name}.parquet"))
    return spark.catalog.tableExists(name)


def read_or_empty(spark: SparkSession, name: str, like: DataFrame,
                  sf_dir: str | None = None) -> DataFrame:
    """S3: the table if it exists, else an empty frame with ``like``'s schema.

    Only a missing table means "empty" (Q15); any other read error is raised.
    """
    if not table_exists(spark, name, sf_dir):
        return spark.createDataFrame([], like.schema)
    try:
        return read_table(spark, name, sf_dir)
    except AnalysisException as e:  # dropped between the check and the read
        if "TABLE_OR_VIEW_NOT_FOUND" in str(e) or "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], like.schema)
        raise


def latest_per_key(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Newest row per key (S4 over a whole registry).

    ``max_by`` on a struct of the order columns is a plain aggregate: partial
    results are merged map-side, so a key holding a third of the rows costs one
    small buffer per task, not a window over the whole key.
    """
    keys = list(key_cols)
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("__r"))
    return agg.select(*keys, *[F.col("__r").getField(c).alias(c) for c in payload])


def lookup(df: DataFrame, key_col: str, key_value, order_cols: Sequence[str] = ()) -> DataFrame:
    """Registry rows for one key (pushed down as an equality filter);
    with ``order_cols`` only the newest row."""
    hit = df.where(F.col(key_col) == F.lit(key_value))
    if order_cols:
        return latest_per_key(hit, [key_col], order_cols)
    return hit
