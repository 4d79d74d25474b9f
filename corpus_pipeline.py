"""The corpus pipeline: five training-data stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; it works on all that its
predecessor kept, written as Parquet and read again in between. All but the
last return the columns of ``documents``; the last returns packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabclass.llm import kneser_ney, mixing, packing, radix, simhash
from tabclass.llm.common import read, staged
from tabclass.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like the trusted ones (labels: quality 1)."""
    return kneser_ney.keep_good(docs, read(spark, sf_dir, "labels"), F.col("quality") == 1)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return radix.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids along the Hilbert curve, one row per piece."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("mix", mix), ("pack", pack)]
#: training on n-grams, fingerprints and tokenizing are beyond SQL: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result but the last is staged."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
