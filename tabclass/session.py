"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tabclass", cpus: int | str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench (local mode). On a cluster the caller's
    session is used as is; nothing here is required by the library."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    if shuffle_partitions is None:
        shuffle_partitions = int(cpus) if str(cpus).isdigit() else 8
    parts = shuffle_partitions
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABCLASS_DRIVER_MEM", "16g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (tests, ad-hoc runs) a folder
    below the SQL warehouse, on the session's own filesystem, is taken instead,
    so lineage cuts and staged writes never land in one machine's temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder (for staged tables)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written to the shared folder (``options`` to the writer) and read back: computed once,
    its size known to the planner, its lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
