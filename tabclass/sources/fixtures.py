"""Named views over the driver's tables (FIXTURES.md) used by queries and tests.

Each builder reads parquet under ``sf_dir`` and is lazy; the same definitions
exist as DuckDB SQL in :mod:`tabclass.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rowwise import argmax_class
from .tables import read_table

SCORE_CLASSES = ("click", "error", "purchase", "signup", "view")
# Fixed integer weight rule of F_SCORED: w_i = 1 + event_id * MULT_i % MOD_i.
SCORE_WEIGHTS = ((7919, 101), (6151, 97), (4093, 89), (3079, 83), (1543, 79))
RARE_PRICE = 470000


def f_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, "orders", sf_dir)
    return o.select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status"),
                    "o_totalprice", "o_custkey", F.month("o_orderdate").alias("m"))


def f_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, "orders", sf_dir)
    return o.select(F.col("o_orderkey").alias("row_id"),
                    F.when(F.col("o_totalprice") > RARE_PRICE, "yes").otherwise("no").alias("status"),
                    "o_totalprice", "o_custkey", F.month("o_orderdate").alias("m"))


def f_sep(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, "events", sf_dir)
    return e.select("event_id", "value", F.hour("ts").alias("hr"), "user_id",
                    F.when(F.col("value") < 20, "low").when(F.col("value") < 70, "mid")
                    .otherwise("high").alias("band"))


def f_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, "embeddings", sf_dir)
    return e.select(F.col("vec_id").alias("id"), "embedding", F.col("label").cast("string").alias("label"))


def f_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label is a step function of one whole-number feature with few values,
    which every tree learner must reproduce exactly."""
    e = read_table(spark, "events", sf_dir)
    hr = F.hour("ts")
    return e.select("event_id", hr.alias("hr"), (F.col("event_id") % 5).alias("noise"),
                    F.when(hr < 8, "night").when(hr < 16, "day").otherwise("eve").alias("part"))


def f_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f_ord(spark, sf_dir).select(
        "row_id", "o_totalprice",
        F.when(F.col("row_id") % 7 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "m",
        F.when(F.col("row_id") % 11 == 0, F.lit(None)).otherwise(F.col("status")).alias("status"))


def f_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, actual, pred, and one score column per class (scores sum to 1)."""
    e = read_table(spark, "events", sf_dir).select("event_id", "event_type")
    ws = [F.lit(1) + (F.col("event_id") * F.lit(a)) % F.lit(m) for a, m in SCORE_WEIGHTS]
    total = ws[0] + ws[1] + ws[2] + ws[3] + ws[4]
    d = e.select(F.col("event_id").alias("id"), F.col("event_type").alias("actual"),
                 *[(w / total).alias(c) for w, c in zip(ws, SCORE_CLASSES)])
    return d.withColumn("pred", argmax_class(SCORE_CLASSES))


def f_scored2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary view of F_SCORED: 'click' vs 'other', scores click and 1 - click."""
    s = f_scored(spark, sf_dir)
    return s.select("id",
                    F.when(F.col("actual") == "click", "click").otherwise("other").alias("actual"),
                    F.col("click"), (F.lit(1.0) - F.col("click")).alias("other"))


def f_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F_ORD without m and target, plus ``x`` and a digit-leading column ``1``."""
    return f_ord(spark, sf_dir).select("row_id", "o_totalprice", "o_custkey",
                                       (F.col("o_custkey") % 10).alias("x"),
                                       (F.col("row_id") % 3).alias("1"))
