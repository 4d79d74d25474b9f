"""Sinks (S5-S9): keyed upsert, replace by key, staged overwrite, CSV export,
run log. Tables are parquet folders (a catalog name works the same way through
``saveAsTable`` where a metastore exists).

Never read and overwrite one path in the same plan: new rows are written to a
staging folder first and then swapped in (S7) or renamed to the place of whole
partitions (S5, S6). Stages are removed when they have been used.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def _fs(spark: SparkSession, path: str):
    """(filesystem, path) through Hadoop, so that any store works."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_at(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds data files. Only a missing or empty folder counts
    as no table; one that can't be read raises when it is read."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store; nothing happens when it is not there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_results(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a result table. The new rows are written beside the target
    and swapped in by renaming; the old table stays until they are complete."""
    spark = df.sparkSession
    path = path.rstrip("/")
    mark = uuid.uuid4().hex[:12]
    stage, old = f"{path}__stage_{mark}", f"{path}__old_{mark}"
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.parquet(stage)
    fs, target = _fs(spark, path)
    _, new_p = _fs(spark, stage)
    _, old_p = _fs(spark, old)
    had = fs.exists(target)
    if had and not fs.rename(target, old_p):
        raise OSError(f"{path} could not be moved aside; the new rows are in {stage}")
    if not fs.rename(new_p, target):
        if had:
            fs.rename(old_p, target)
        raise OSError(f"the new rows could not be moved to {path}; they are in {stage}")
    if had:
        fs.delete(old_p, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def persist_data(df: DataFrame, path: str, keys: Sequence[str],
                 partition_by: str | None = None) -> DataFrame:
    """Keyed upsert: rows of ``df`` replace stored rows with the same key.

    ``df`` is evaluated once, into the staging area; its keys, its partitions
    and its rows are read from there. ``old LEFT ANTI JOIN new_keys`` keeps
    untouched rows, ``unionByName`` adds the new ones.

    With ``partition_by`` (a key column such as ``model_id``) the table is
    partitioned by it: only the partitions present in ``df`` are read (pruned
    scan) and replaced (dynamic partition overwrite); other models' rows are
    neither read nor rewritten.
    """
    spark = df.sparkSession
    keys = list(keys)
    parts = [partition_by] if partition_by else []
    if not table_at(spark, path):
        return write_results(df, path, parts)
    stage = scratch_path(spark, "stage")
    df.write.parquet(stage)
    new = spark.read.schema(df.schema).parquet(stage)
    old = spark.read.parquet(path)
    if partition_by:
        touched = [r[0] for r in new.select(partition_by).distinct().collect()]  # a few model ids
        old = old.where(F.col(partition_by).isin(touched))
    merged = (old.join(new.select(*keys).distinct(), keys, "left_anti")
              .unionByName(new, allowMissingColumns=True))
    out = replace_by_key(merged, path, partition_by) if partition_by else write_results(merged, path)
    drop_folder(spark, stage)
    return out


def replace_by_key(df: DataFrame, path: str, key: str = "model_id", values: Sequence | None = None) -> DataFrame:
    """Delete-then-insert by key: the ``key`` partitions present in ``df`` are replaced as a
    whole, others stay. ``values`` are keys replaced in any case: one that ``df`` has no row of is left
    without rows. The rows are written once, beside the table, and their partitions put in place by
    renaming, so that ``df`` may read ``path`` and a failing ``df`` leaves the table as it was."""
    spark, path = df.sparkSession, path.rstrip("/")
    stage = f"{path}__stage_{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(key).parquet(stage)
    fs, new = _fs(spark, stage)
    fs.mkdirs(_fs(spark, path)[1])
    there = {f.getPath().getName(): f.getPath() for f in fs.listStatus(new) if f.isDirectory()}  # a few keys
    for name, folder in there.items():
        drop_folder(spark, f"{path}/{name}")
        if not fs.rename(folder, _fs(spark, f"{path}/{name}")[1]):
            raise OSError(f"{name} could not be moved to {path}; its rows are in {stage}")
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for v in {str(v) for v in values or ()}:
        if (name := f"{escape(key)}={escape(v)}") not in there:
            drop_folder(spark, f"{path}/{name}")
    drop_folder(spark, stage)
    spark.catalog.refreshByPath(path)
    if not table_at(spark, path):
        return spark.createDataFrame([], df.schema)
    # the key keeps its type: a folder named 1 is not a number of its own accord
    stored = spark.read.parquet(path).schema
    return spark.read.schema(StructType([df.schema[f.name] if f.name == key else f for f in stored])).parquet(path)


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


RUN_SCHEMA = ("run_id string, model_id string, run_name string, kind string, name string, "
              "value string, ts timestamp")


def log_run(metrics: DataFrame, path: str, run_id: str, model_id: str, run_name: str, kind: str,
            name_col: str = "Metric", value_col: str = "Value") -> DataFrame:
    """S9 for one kind: see :func:`log_kinds`."""
    return log_kinds({kind: metrics.select(F.col(name_col).alias("name"), F.col(value_col).alias("value"))}, path, run_id,
                     model_id, run_name)


def log_kinds(kinds: dict[str, DataFrame], path: str, run_id: str, model_id: str, run_name: str) -> DataFrame:
    """The run's (run_id, model_id, run_name, kind, name, value, ts) rows from frames with ``name`` and
    ``value``, by kind. The log is partitioned by run and kind: writing a run again, as a retried job does,
    replaces its rows of these kinds and changes no other run."""
    out = None
    for kind, d in kinds.items():
        rows = d.select(F.lit(model_id).alias("model_id"), F.lit(run_name).alias("run_name"),
                        F.col("name").cast("string").alias("name"), F.col("value").cast("string").alias("value"),
                        F.current_timestamp().alias("ts"), F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"))
        out = rows if out is None else out.unionByName(rows)
    spark = out.sparkSession
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "kind").parquet(path))
    spark.catalog.refreshByPath(path)
    return read_log(spark, path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


__all__ = ["write_results", "persist_data", "replace_by_key", "export_csv", "read_csv", "log_run", "log_kinds", "read_log",
           "RUN_SCHEMA"]
