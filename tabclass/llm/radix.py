"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by byte length and their first bytes, then by the bytes
that follow, in longer and longer runs, until a group holds one document or its
texts have ended. Documents that end in the same group have gone through the
same bytes and are equal; no digest takes part in that decision.

A round counts its groups with map-side partial sums (one key may hold a third
of all rows), numbers the groups of two and more, and joins the numbers back by
a sort-merge join at every size, which adaptive execution splits where a key is
hot. Only documents still undecided carry their remaining bytes on, and every
round is written to the shared folder.

Defined results: a null text is the empty text; empty texts are equal; rows
with the same id are separate documents of one group, all marked kept if that
id stays; a group of null ids has keep id null and all its rows stay; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged, text_of

FIRST = 64
FACTOR = 16


def radix_groups(docs: DataFrame, id_col="doc_id", text_col="text", first: int = FIRST,
                 factor: int = FACTOR) -> DataFrame:
    """``doc_id, keep_id, group_size, text_sha256`` for each document."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("gid"),
                       F.unhex(F.sha2(text, 256)).alias("sha"), text.cast("binary").alias("rest"))
    run, decided, depth = first, [], 0
    while True:
        # next run of bytes; `ended` tells whether any byte is left after it
        cut = rows.select("doc_id", "gid", "sha", F.substring("rest", 1, run).alias("chunk"),
                          F.expr(f"substring(rest, {run + 1})").alias("rest"))
        cut = cut.withColumn("ended", F.octet_length("rest") == 0)
        groups = (cut.groupBy("gid", "chunk", "ended")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
                  .where("n > 1").withColumn("next_gid", F.monotonically_increasing_id()))
        groups = staged(groups, f"radix-groups-{depth}")
        key = [cut.gid == groups.gid, cut.chunk == groups.chunk, cut.ended == groups.ended]
        goes_on = groups.n.isNotNull() & ~cut.ended
        step = cut.join(groups.hint("merge"), key, "left").select(
            cut.doc_id, cut.sha, groups.next_gid.alias("gid"), goes_on.alias("open"),
            F.coalesce(groups.n, F.lit(1)).alias("n"),
            F.when(groups.n.isNull(), cut.doc_id).otherwise(groups.keep_id).alias("keep_id"),
            F.when(goes_on, cut.rest).alias("rest"))
        step = staged(step, f"radix-{depth}")
        decided.append(step.where(~F.col("open")).select("doc_id", "keep_id", "n", "sha"))
        rows = step.where("open").select("doc_id", "gid", "sha", "rest")
        if rows.isEmpty():
            break
        run, depth = run * factor, depth + 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionAll(d)
    return out.select("doc_id", "keep_id", F.col("n").cast("long").alias("group_size"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def with_kept(groups: DataFrame) -> DataFrame:
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def drop_copies(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` with one row of each text: the one with the largest id. Rows are
    told apart by a row number of their own, so no text is lost where an id is
    repeated or null (a null id counts as the smallest)."""
    rid, key = fresh(docs, "rid", "row_key")
    rows = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "radix-rows")
    keyed = rows.withColumn(key, F.struct(F.col(id_col).isNotNull().alias("has_id"), F.col(id_col).alias("doc_id"),
                                          F.col(rid).alias("rid")))
    gone = with_kept(radix_groups(keyed, key, text_col)).where("not kept").select(F.col("doc_id.rid").alias(rid))
    return rows.join(gone, rid, "left_anti").select(*docs.columns)


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256 FROM documents
"""
