"""User models per group (G1): a grouped map whose groups are never larger than stated.

``fit`` sees the rows of a group as a pandas frame and returns its state, a few rows. Group
sizes are counted first; a group of more than ``max_rows`` is dealt in shards of about that
many rows, ``fit`` gives one state per shard, and ``merge`` joins the states of a group. A
group that holds a third of all rows is then the work of many tasks instead of one that fails.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rowwise import lookup_small
from ..session import staged

MAX_ROWS = 1_000_000


def map_groups(df: DataFrame, key: str, fit: Callable[[pd.DataFrame], pd.DataFrame], state: str,
               merge: Callable[[pd.DataFrame], pd.DataFrame], out: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """``fit``: rows of a shard (all columns) -> its state (columns of the DDL ``state``); ``merge``: the states of
    a group -> its result (DDL ``out``). Both get the group's key in the column ``key`` and must return it. Null is a group."""
    cols = df.columns
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("none"))
    d = df.withColumn("__group", group)
    sizes = (d.groupBy("__group").agg(F.count(F.lit(1)).alias("n"))
             .select("__group", F.ceil(F.col("n") / max_rows).cast("long").alias("__shards")))
    # dealt by place, so that equal rows spread too; written once, so that a re-run deals alike
    dealt = staged(lookup_small(d, sizes, "__group", ["__shards"]).withColumn(
        "__shard", F.pmod(F.monotonically_increasing_id(), F.col("__shards"))), "group-shards")
    states = dealt.groupBy("__group", "__shard").applyInPandas(lambda pdf: fit(pdf[cols]), state)
    return states.groupBy(F.col(f"`{key}`")).applyInPandas(merge, out)
