"""Re-sampling (M3, M4), sampling policy (M6) and model combinations (M7).

Samplers are deterministic functions of ``(seed, id)``: a class is put in a
random order by ``md5('<seed>:<id>')`` (two-level rank, no single-task class
window) and rows are kept or copied by their rank. Counts equal the
imbalanced-learn samplers (every class cut to the minority / raised to the
majority count); the random stream does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_MODELS, IMBALANCE_LIMIT, UNDER_SAMPLING_FLOOR
from ..functions.hashing import hash32, hash_bucket
from ..functions.ranking import hash_bits_for, rank_within
from ..functions.rowwise import lookup_small


def hash_rank(df: DataFrame, target: str, id_col: str, seed, out: str = "__rank",
              max_class_rows: int = 0) -> DataFrame:
    """1-based rank of each row inside its class in md5('<seed>:<id>') order;
    hash buckets sized from the largest class."""
    d = df.withColumn("__h", hash32(seed, F.col(id_col)))
    return rank_within(d, [target], ["__h", id_col], out=out,
                       bucket=hash_bucket(F.col("__h"), hash_bits_for(max_class_rows))).drop("__h")


CHUNK = 1000  # copies one row makes in one go


def with_class_stats(df: DataFrame, target: str) -> tuple[DataFrame, int]:
    """Adds __n (class size), __min and __max (smallest / largest class); also
    returns the largest size. One aggregate, attached by :func:`lookup_small`."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("__n"))
    ext = counts.agg(F.min("__n").alias("lo"), F.max("__n").alias("hi")).first()
    lo, hi = int(ext["lo"] or 0), int(ext["hi"] or 0)
    d = lookup_small(df, counts, target, ["__n"])
    return d.withColumns({"__min": F.lit(lo).cast("bigint"), "__max": F.lit(hi).cast("bigint")}), hi


def emit_copies(df: DataFrame, id_col: str, count: str, out: str, first: int) -> DataFrame:
    """Repeats each row with ``out`` = first .. ``count``. A row with more than
    CHUNK copies is first cut into runs that are dealt out by (id, run), so that
    a handful of rows can make a whole class without one task making it."""
    few = df.where(F.col(count) <= CHUNK).withColumn(
        out, F.explode(F.sequence(F.lit(first).cast("long"), F.col(count))) if first == 0 else
        F.explode(F.when(F.col(count) >= first, F.sequence(F.lit(first).cast("long"), F.col(count)))))
    many = df.where(F.col(count) > CHUNK).withColumn(
        "__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col(count) / CHUNK))))
    lo = F.greatest(F.lit(first).cast("long"), F.col("__run") * CHUNK)
    hi = F.least(F.col(count), F.col("__run") * CHUNK + CHUNK - 1)
    # a fixed number of partitions: runs are few bytes before and many rows after
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(parts, F.col(id_col), F.col("__run")).withColumn(
        out, F.explode(F.when(lo <= hi, F.sequence(lo, hi)))).drop("__run")
    return few.unionByName(many)


def under_sample(df: DataFrame, target: str = "target", id_col: str = "id", seed=1) -> DataFrame:
    """M3: every class cut to the minority count (rows with the smallest draws)."""
    s, top = with_class_stats(df, target)
    d = hash_rank(s, target, id_col, f"us{seed}", max_class_rows=top)
    return d.where(F.col("__rank") <= F.col("__min")).drop("__rank", "__n", "__min", "__max")


def over_sample_weights(df: DataFrame, target: str = "target", id_col: str = "id", seed=1,
                        weight_col: str = "weight") -> DataFrame:
    """M4 without copies: every row once, with the number of times over-sampling
    would have it (the same draws as :func:`over_sample`)."""
    s, top = with_class_stats(df, target)
    d = hash_rank(s, target, id_col, f"os{seed}", max_class_rows=top)
    return d.withColumn(weight_col, (_extra_copies() + 1).cast("double")).drop("__rank", "__n", "__min", "__max")


def _extra_copies():
    e = F.col("__max") - F.col("__n")
    return F.when(F.col("__rank") <= e, F.floor((e - F.col("__rank")) / F.col("__n")) + 1).otherwise(0)


def over_sample(df: DataFrame, target: str = "target", id_col: str = "id", seed=1,
                copy_col: str = "copy_no") -> DataFrame:
    """M4: every class raised to the majority count by repeating rows.

    A class with n rows needing e = max - n extra rows deals the extras
    round-robin over its rows in random (hash) order: the row of rank r makes
    ``floor((e - r) / n) + 1`` copies when r <= e, in runs that are dealt out
    (:func:`emit_copies`).
    Originals carry ``copy_no`` 0, extras 1, 2, ...
    """
    s, top = with_class_stats(df, target)
    d = hash_rank(s, target, id_col, f"os{seed}", max_class_rows=top)
    d = d.withColumn("__c", _extra_copies().cast("long")).drop("__rank", "__n", "__min", "__max")
    return emit_copies(d, id_col, "__c", copy_col, 0).drop("__c")


def sampling_plan(history: DataFrame, train: DataFrame, target: str = "target",
                  limit: float = IMBALANCE_LIMIT, floor: int = UNDER_SAMPLING_FLOOR,
                  preferred: str | None = None) -> DataFrame:
    """M6: the sampling names to search, one row each (``sampling_type``).

    'NA' always; 'us' when imbalanced and the under-sampled train set
    (classes x minority count) exceeds ``floor``; 'smote' and 'os' when
    imbalanced. Imbalance is measured on all history, the under-sampling size on
    the train part (as in the reference). A preferred sampling replaces the list.
    """
    spark = history.sparkSession
    if preferred:
        return spark.createDataFrame([(preferred, 0)], "sampling_type string, ord int")
    h = history.groupBy(target).count().agg(F.min("count").alias("lo"), F.max("count").alias("hi")).first()
    t = train.groupBy(target).count().agg(F.count(F.lit(1)).alias("k"), F.min("count").alias("lo")).first()
    imb = round(h["lo"] / h["hi"], 4) < limit          # two scalars each: class-count aggregates
    us_rows = int(t["k"]) * int(t["lo"])
    rows = [("NA", 0)] + ([("us", 1)] if imb and us_rows > floor else []) + \
        ([("smote", 2), ("os", 3)] if imb else [])
    return spark.createDataFrame(rows, "sampling_type string, ord int")


def model_combos(plan: DataFrame, models: Sequence[str] = DEFAULT_MODELS,
                 stored: DataFrame | None = None) -> DataFrame:
    """M7: model x sampling combinations (``model_name``, ``sampling_type``,
    ``combo`` = '<model>_<sampling>', ``ord``). With a ``stored`` registry row
    (columns model_name = combo) that combo alone is used."""
    arr = F.array(*[F.struct(F.lit(m).alias("model_name"), F.lit(i).alias("mi"))
                    for i, m in enumerate(models)])
    c = (plan.select("sampling_type", "ord", F.explode(arr).alias("m"))
         .select(F.col("m.model_name").alias("model_name"), "sampling_type",
                 (F.col("m.mi") * 100 + F.col("ord")).alias("ord")))
    c = c.withColumn("combo", F.concat_ws("_", "model_name", "sampling_type"))
    if stored is not None:
        s = stored.select(F.col("model_name").alias("combo")).limit(1)
        s = s.select(F.split("combo", "_").getItem(0).alias("model_name"),
                     F.split("combo", "_").getItem(1).alias("sampling_type"),
                     F.lit(0).alias("ord"), "combo")
        return s
    return c
