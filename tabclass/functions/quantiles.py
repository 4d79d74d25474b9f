"""Exact quantiles (linear interpolation) without one task holding every value.

Spark's exact ``percentile`` merges every distinct value of a group into one
final buffer. Here the work is split, for all groups at once:

1. one aggregate: approximate boundaries per group (a bounded sketch each) cut
   its values into cells;
2. one aggregate: rows per (group, cell);
3. the cells that hold a needed order position are kept. A cell of more than
   ROWS_PER_BUCKET rows is a group of its own in the next round (a few rounds
   at any size, never a loop over groups); the others are collapsed to (value,
   count) - duplicates of a hot value merge map-side - and ranked by a window
   per cell;
4. the values at those positions come back (<= 2 per quantile per group) and
   are interpolated as ``v[lo] + (h - lo) * (v[hi] - v[lo])``, ``h = (n - 1) q``
   - the rule of Spark ``percentile`` and DuckDB ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import ROWS_PER_BUCKET, with_range_bucket
from .rowwise import lookup_small

N_BUCKETS = 64


def grouped_exact_quantiles(df: DataFrame, group_col: str | None, value_col: str,
                            qs: Sequence[float], n_buckets: int = N_BUCKETS) -> dict:
    """{group: [quantile per q]} (no entry for empty groups). ``group_col`` None = one group, 0."""
    g = F.col(f"`{group_col}`") if group_col else F.lit(0)
    # one projected column, kept for the passes (the input may be model output)
    v = (df.select(g.alias("g"), F.col(f"`{value_col}`").cast("double").alias("v")).where(F.col("v").isNotNull())
         .persist())
    try:
        counts = {r["g"]: int(r["n"]) for r in v.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        spots = {key: [((n - 1) * float(q)) for q in qs] for key, n in counts.items()}
        wanted = {key: {p for h in hs for p in (math.floor(h), math.ceil(h))} for key, hs in spots.items()}
        at = _values_at(v, wanted, n_buckets)
        out = {}
        for key, hs in spots.items():
            lo = [at[(key, math.floor(h))] for h in hs]
            hi = [at[(key, math.ceil(h))] for h in hs]
            out[key] = [a + (h - math.floor(h)) * (c - a) for h, a, c in zip(hs, lo, hi)]
        return out
    finally:
        v.unpersist()


def _cells(d: DataFrame, n_buckets: int) -> DataFrame:
    """Adds ``bk``, non-decreasing in ``v`` inside each ``cell``."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    heads = d.groupBy("cell").agg(F.percentile_approx("v", probs, 100 * n_buckets).alias("b")).collect()
    bounds = {h["cell"]: sorted({float(x) for x in h["b"]}) for h in heads}
    if len(bounds) == 1:  # the same cut by binary search
        only = next(iter(bounds.values()))
        return with_range_bucket(d, "v", "bk", splits=[float("-inf"), *only, float("inf")])
    # bounds at or below v by binary search; NaN, which Spark orders last, fills up to 2^n - 1 bounds
    half = 1 << (max(map(len, bounds.values())).bit_length() - 1)
    full = {c: sorted(b, key=lambda x: (math.isnan(x), x)) + [math.nan] * (2 * half - 1 - len(b)) for c, b in bounds.items()}
    table = d.sparkSession.createDataFrame(list(full.items()), "cell long, bounds array<double>")
    d = lookup_small(d, table, "cell", ["bounds"]).withColumn("bk", F.lit(0))
    while half:  # a column a step: each is used twice by the next
        at = F.get("bounds", F.col("bk") + F.lit(half - 1))
        d = d.withColumn("bk", F.col("bk") + F.when(at <= F.col("v"), half).otherwise(0))
        half //= 2
    return d.drop("bounds")


def _values_at(v: DataFrame, wanted: dict, n_buckets: int) -> dict:
    """{(group, position): value} for the wanted 0-based positions of each group."""
    spark = v.sparkSession
    number = {key: i for i, key in enumerate(wanted)}
    if len(number) == 1:
        d = v.select(F.lit(0).cast("long").alias("cell"), "v")
    else:
        table = spark.createDataFrame(list(number.items()), f"g {v.schema['g'].dataType.simpleString()}, cell long")
        d = lookup_small(v, table, "g", ["cell"]).select("cell", "v")
    # what each cell has to answer: position inside it -> the questions (group, position)
    ask = {number[key]: {p: [(key, p)] for p in ps} for key, ps in wanted.items()}
    out: dict = {}
    while ask:
        d = _cells(d, n_buckets)
        counts: dict = {}
        for r in d.groupBy("cell", "bk").agg(F.count(F.lit(1)).alias("c")).collect():  # cells x buckets
            counts.setdefault(r["cell"], []).append((r["bk"], int(r["c"])))
        ready, deeper = {}, {}
        for cell, questions in ask.items():
            start, here = 0, sorted(counts[cell])
            for bk, c in here:
                inside = {p - start: q for p, q in questions.items() if start <= p < start + c}
                if inside:
                    # one bucket for all rows: no cut is possible, its values are few
                    goes_on = c > ROWS_PER_BUCKET and len(here) > 1
                    (deeper if goes_on else ready)[(cell, bk)] = inside
                start += c
        out.update(_ranked(d, ready))
        ask = dict(enumerate(deeper.values()))
        if ask:
            table = spark.createDataFrame([(c, b, i) for i, (c, b) in enumerate(deeper)], "cell long, bk int, next long")
            d = (lookup_small(d, table, ["cell", "bk"], ["next"]).where("next is not null")
                 .select(F.col("next").alias("cell"), "v"))
    return out


def _ranked(d: DataFrame, ready: dict) -> dict:
    """Answers from cells small enough to rank: one window per cell."""
    if not ready:
        return {}
    spark = d.sparkSession
    ids = {key: i for i, key in enumerate(ready)}
    cells = spark.createDataFrame([(c, b, i) for (c, b), i in ids.items()], "cell long, bk int, id long")
    w = Window.partitionBy("id").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (lookup_small(d, cells, ["cell", "bk"], ["id"]).where("id is not null")
              .groupBy("id", "v").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("hi", F.sum("c").over(w)).withColumn("lo", F.col("hi") - F.col("c")))
    asked = spark.createDataFrame([(ids[key], p) for key, inside in ready.items() for p in inside], "id long, p long")
    found = ranked.join(asked, "id").where((F.col("lo") <= F.col("p")) & (F.col("hi") > F.col("p")))
    keys = list(ready)
    return {q: float(r["v"]) for r in found.select("id", "p", "v").collect() for q in ready[keys[r["id"]]][r["p"]]}


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float],
                    n_buckets: int = N_BUCKETS) -> list[float | None]:
    res = grouped_exact_quantiles(df, None, col, qs, n_buckets)
    return res.get(0, [None for _ in qs])
