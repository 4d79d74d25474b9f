"""SMOTE (M5): raise every class to the majority count with synthetic rows.

A class with n rows needing e = max - n new rows deals them round-robin over
its rows in hash order (as :func:`over_sample`); for its j-th new row a base row
``a`` takes one of its ``k`` nearest same-class neighbours ``b`` (picked by
``md5('<seed>:nb:<id>:<j>') mod k``) and a step ``u`` in [0, 1) (from
``md5('<seed>:u:<id>:<j>')``) and emits ``a + u * (b - a)`` component-wise
(``zip_with``). Neighbours come from the blocked kNN (exact unless asked otherwise), never a pair table, and
travel with the seed row in one array; the copies are then made row by row.
Features must not be null: impute first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32, hash_unit
from ..session import staged
from .knn import DEFAULT_BLOCK_ROWS
from .knn_lsh import search
from .sampling import emit_copies, hash_rank, with_class_stats


def smote(df: DataFrame, features: Sequence[str], target: str = "target", id_col: str = "id",
          k: int = 5, seed=1, block_rows: int = DEFAULT_BLOCK_ROWS,
          neighbours: str = "exact") -> DataFrame:
    """Original rows plus synthetic ones; columns: id, features..., target,
    ``synthetic`` (bool), ``copy_no``, ``nb_id`` (the neighbour used), ``u``. ``neighbours``: 'exact', or 'lsh' for the
    approximate search of :mod:`.knn_lsh`."""
    feats = list(features)
    vec = F.array(*[F.col(f"`{c}`").cast("double") for c in feats])
    base = df.select(F.col(id_col).alias("id"), F.col(target).alias("target"), vec.alias("fv"))
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    too_small = counts.where(F.col("n") <= k).count()
    if too_small:
        raise ValueError(f"SMOTE needs more than k={k} rows in every class; {too_small} class(es) have fewer")
    if not base.where(F.exists("fv", lambda x: x.isNull() | F.isnan(x))).isEmpty():
        raise ValueError("SMOTE needs features without nulls: impute them first")
    st, top = with_class_stats(base, "target")
    growing = st.where(F.col("__n") < F.col("__max"))  # the other classes make no rows and are no neighbours
    d = hash_rank(growing, "target", "id", f"sm{seed}", max_class_rows=top)
    e = F.col("__max") - F.col("__n")
    copies = F.when(F.col("__rank") <= e, F.floor((e - F.col("__rank")) / F.col("__n")) + 1).otherwise(0)
    makers = d.withColumn("__c", copies.cast("long")).where(F.col("__c") > 0).select("id", "target", "fv", "__c")
    makers = staged(makers, "smote-makers")  # read by the search, its block counts and the copies
    # neighbours only for rows that make new rows, each with its vector; k per row
    nn = search(neighbours)(makers, growing, k, features="fv", part_cols=["target"], exclude_self=True,
                            block_rows=block_rows, carry=["fv"])
    near = nn.groupBy(F.col("qid").alias("id")).agg(F.array_sort(F.collect_list(
        F.struct("nn_rank", F.col("cid").alias("nb_id"), F.col("fv").alias("bv")))).alias("near"))
    need = emit_copies(makers.join(near, "id"), "id", "__c", "copy_no", 1)
    pick = (hash32(f"{seed}:nb", F.col("id"), F.col("copy_no")) % F.size("near") + 1).cast("int")
    u = hash_unit(f"{seed}:u", F.col("id"), F.col("copy_no"))
    syn = (need.withColumn("nb", F.element_at("near", pick)).withColumn("u", u)
           .withColumn("nb_id", F.col("nb.nb_id"))
           .withColumn("nv", F.zip_with("fv", F.col("nb.bv"), lambda a, b: a + F.col("u") * (b - a))))
    out_syn = syn.select("id", *[F.col("nv")[i].alias(c) for i, c in enumerate(feats)], "target",
                         F.lit(True).alias("synthetic"), "copy_no", "nb_id", "u")
    out_orig = base.select("id", *[F.col("fv")[i].alias(c) for i, c in enumerate(feats)], "target",
                           F.lit(False).alias("synthetic"), F.lit(0).cast("long").alias("copy_no"),
                           F.lit(None).cast(base.schema["id"].dataType).alias("nb_id"), F.lit(None).cast("double").alias("u"))
    return out_orig.unionByName(out_syn)
