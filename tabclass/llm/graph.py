"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, name="components") -> DataFrame:
    """``node, root``: for every node of the links, the smallest node reachable.

    Large-star links every larger neighbour of a node to the smallest one of
    its neighbourhood, small-star every smaller one; both keep the components,
    and they end in stars around the roots."""
    e = staged(edges.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
               .distinct(), name)
    while True:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(joined.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        new = staged(small.select("v", "u"), name)
        same = new.unionAll(e).groupBy("u", "v").agg(F.count(F.lit(1)).alias("n")).where("n <> 2").isEmpty()
        e = new
        if same:
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
