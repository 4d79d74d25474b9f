"""Mixing sources to target weights: token targets per source, seeded repetition.

Sizes are summed per source; targets share ``share`` times all words by weight,
each stopping at ``cap`` times its source's size while the excess goes to the
others by weight. A document is emitted ``floor(rate)`` times, and once more
when its hash draw is below the fraction of the rate.

The capped shares have a closed form. Sources ordered by ``cap * size / weight``
reach their cap in that order, so a source is capped when what is left of the
budget, split by weight over it and all later sources, gives it its cap or more.

Defined results: a null text has no words; null is a source of its own and comes
last; a source without words has target 0 and its documents are taken 0 times;
rows with the same id (or a null id) share one draw, so repeated rows are
repeated alike; an empty table gives an empty result. Extra columns are ignored
by :func:`plan_mix` and carried along by :func:`apply_mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from .common import WORD, fresh, staged

WEIGHTS = (5, 2, 1)
SEED = 8


def words(col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``(source, size)`` rows -> one row per source: ``source, source_size, target``."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # windows over the table of sources only: one row per source
    order = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("idx", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "idx")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = (per.withColumn("left_over", F.sum("source_size").over(whole) * F.lit(float(share))
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("w_left", F.sum("w").over(onward))
           .withColumn("capped", F.col("cap") <= F.col("w") * F.col("left_over") / F.col("w_left")))
    open_w = F.when(~F.col("capped"), F.col("w"))
    per = (per.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share))
                          - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0.0)))
           .withColumn("open_w", F.sum(open_w).over(whole)))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("budget") / F.col("open_w"))
    return per.select("source", "source_size", target.alias("target"))


def copies(doc_id: Column, source_size: Column, target: Column, seed=SEED) -> Column:
    """floor(rate) plus one when the document's draw is below the fraction."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    draw = hash_unit(seed, F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def _rates(docs: DataFrame, text_col: str, source_col: str, weights, share, cap) -> DataFrame:
    """One staged row per source. Its file size is known to the planner, which
    broadcasts it below the session's threshold and joins by shuffle above."""
    sized = docs.select(F.col(source_col).alias("source"), words(text_col).alias("size"))
    return staged(source_targets(sized, weights, share, cap), "mix-rates")


def plan_mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
             share: float = 1.5, cap: float = 2.0, seed=SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sized = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               words(text_col).alias("size")), "mix-sizes")
    rates = staged(source_targets(sized, weights, share, cap), "mix-rates")
    rates = rates.withColumnRenamed("source", "rate_source")
    n = copies(F.col("doc_id"), F.col("source_size"), F.col("target"), seed)
    return (sized.join(rates, F.col("source").eqNullSafe(F.col("rate_source")), "left")
            .withColumn("copies", n).withColumn("taken", F.col("copies") * F.col("size")).drop("rate_source"))


def apply_mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
              share: float = 1.5, cap: float = 2.0, seed=SEED) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, same columns."""
    rates = _rates(docs, text_col, source_col, weights, share, cap)
    s, z, t, n = fresh(docs, "rate_source", "rate_size", "rate_target", "copy_no")
    rates = rates.toDF(s, z, t)
    joined = docs.join(rates, docs[source_col].eqNullSafe(rates[s]), "left")
    k = copies(joined[id_col], joined[z], joined[t], seed)
    return (joined.withColumn(n, F.explode(F.array_repeat(F.lit(1), k.cast("int")))).select(*docs.columns))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
a AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS idx FROM per),
b AS (SELECT *, CASE idx % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             source_size * 2.0::DOUBLE AS cap FROM a),
c AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total,
  coalesce(sum(cap) OVER (ORDER BY cap / w, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(w) OVER (ORDER BY cap / w, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM b),
d AS (SELECT *, cap <= w * (total - used) / w_left AS capped FROM c),
e AS (SELECT *, total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS budget,
  sum(CASE WHEN NOT capped THEN w END) OVER () AS open_w FROM d),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE w * budget / open_w END AS target FROM e),
r AS (SELECT s.*, t.source_size, t.target,
  CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  CAST(('0x' || substr(md5('8:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) * size AS taken FROM r
"""
