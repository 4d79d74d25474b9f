"""Exact ranks and running sums without one task per group.

A plain ``row_number().over(Window.partitionBy(label).orderBy(x))`` sends a
whole class to one task; a window with no partition at all sends the whole
table. Both are replaced here by a two-level scheme:

1. cut the order key into buckets (the top bits of a uniform hash, or ranges
   from approximate quantiles of the key),
2. rank / sum inside ``(group, bucket)`` with an ordinary window — each window
   partition holds about 1/B of a group,
3. add the running total of the earlier buckets of the same group, taken from a
   ``(group, bucket)`` count table whose size is groups x B (small; AQE
   broadcasts it when its runtime size is under the broadcast threshold).

The numbers equal the plain window exactly; only the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .rowwise import lookup_small

DEFAULT_BUCKETS = 64
ROWS_PER_BUCKET = 2_000_000   # target rows per window partition


def buckets_for(max_group_rows: int, rows_per_bucket: int | None = None,
                floor: int = DEFAULT_BUCKETS) -> int:
    """Bucket count so the largest group's window partitions hold about
    ``rows_per_bucket`` rows, ``floor`` at least; it grows with the data."""
    return int(max(floor, -(-int(max_group_rows) // (rows_per_bucket or ROWS_PER_BUCKET))))


def hash_bits_for(max_group_rows: int) -> int:
    """Hash-prefix bits giving ~ROWS_PER_BUCKET rows per (group, bucket); >= 8."""
    return max(8, (buckets_for(max_group_rows, floor=256) - 1).bit_length())


def _cols(xs) -> list:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        return [xs]
    return list(xs)


def range_splits(df: DataFrame, col: str, n_buckets: int | None = DEFAULT_BUCKETS,
                 accuracy: int = 10000) -> list[float]:
    """Bucketizer splits from approximate quantiles of ``col``.

    ``n_buckets`` None sizes the buckets from the row count (one extra pass
    only when more than DEFAULT_BUCKETS are needed), one per ROWS_PER_BUCKET
    rows; only the balance of the buckets depends on the sketch, never the
    exactness of what is built on them.
    """
    nb = n_buckets or DEFAULT_BUCKETS
    if nb <= 1:
        return [float("-inf"), float("inf")]
    x = F.col(col).cast("double")
    row = df.agg(F.count(x).alias("n"),
                 F.percentile_approx(x, [i / nb for i in range(1, nb)], accuracy).alias("b")).first()
    if n_buckets is None and buckets_for(row["n"] or 0) > nb:
        nb = buckets_for(row["n"])
        row = df.agg(F.percentile_approx(x, [i / nb for i in range(1, nb)], max(accuracy, 4 * nb))
                     .alias("b")).first()
    bounds = sorted({float(b) for b in (row["b"] or []) if b is not None})
    return [float("-inf")] + bounds + [float("inf")]


def sampled_bounds(df: DataFrame, col: str, n_buckets: int | None = DEFAULT_BUCKETS) -> list:
    """At most ``n_buckets`` - 1 values of ``col`` that cut it into ranges, from
    a bounded set of rows picked by hash (they only balance the ranges)."""
    nb = n_buckets or DEFAULT_BUCKETS
    v = df.select(F.col(f"`{col}`").alias("v")).where("v is not null")
    got = sorted(r[0] for r in v.orderBy(F.xxhash64("v")).limit(32 * nb).collect())
    return sorted(set(got[len(got) * i // nb] for i in range(1, nb))) if got else []


def with_range_bucket(df: DataFrame, col: str, out: str, n_buckets: int | None = DEFAULT_BUCKETS,
                      splits: Sequence[float] | None = None) -> DataFrame:
    splits = list(splits) if splits is not None else range_splits(df, col, n_buckets)
    if len(splits) < 3:  # no bounds (no rows, or one bucket asked for): one range
        return df.withColumn(out, F.lit(0))
    tmp = f"__{out}_d"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    d = df.withColumn(tmp, F.col(col).cast("double"))
    return b.transform(d).drop(tmp).withColumn(out, F.col(out).cast("int"))


def _bucket_offsets(df: DataFrame, part: list, bucket: str, value_cols: dict[str, Column]) -> DataFrame:
    """Per (part, bucket): sum of ``value_cols`` over the earlier buckets of the part."""
    totals = df.groupBy(*part, bucket).agg(*[v.alias(k) for k, v in value_cols.items()])
    if part:
        w = (Window.partitionBy(*part).orderBy(bucket)
             .rowsBetween(Window.unboundedPreceding, -1))
        return totals.select(*part, bucket, *[
            F.coalesce(F.sum(k).over(w), F.lit(0)).alias(f"{k}_off") for k in value_cols])
    # No group: the table has at most B rows; prefix it on the driver.
    rows = sorted(totals.collect(), key=lambda r: (r[bucket] is None, r[bucket]))
    acc = {k: 0 for k in value_cols}
    out = []
    for r in rows:
        out.append((r[bucket], *[acc[k] for k in value_cols]))
        for k in value_cols:
            acc[k] += r[k] or 0
    spark = df.sparkSession
    schema = f"{bucket} int, " + ", ".join(
        f"{k}_off {totals.schema[k].dataType.simpleString()}" for k in value_cols)
    return F.broadcast(spark.createDataFrame(out, schema))


def _with_bucket(df: DataFrame, order: list, bcol: str, bucket: Column | None, n_buckets: int | None) -> DataFrame:
    """Adds ``bcol``, non-decreasing in ``order``: ``bucket``, or ranges of the first order column."""
    if bucket is not None:
        return df.withColumn(bcol, bucket)
    name = order[0] if isinstance(order[0], str) else None
    if name is None:
        raise ValueError("bucket is required when the leading order key is an expression")
    kind = df.schema[name].dataType
    if isinstance(kind, NumericType):
        return with_range_bucket(df, name, bcol, n_buckets)
    bounds = sampled_bounds(df, name, n_buckets)  # any other type: ranges between sampled values of that type
    b = F.array(*[F.lit(x) for x in bounds]) if bounds else F.array().cast(f"array<{kind.simpleString()}>")
    return df.withColumn(bcol, F.size(F.filter(b, lambda x: x < F.col(f"`{name}`"))))


def rank_within(df: DataFrame, part_cols, order_cols, out: str = "rank",
                bucket: Column | None = None, n_buckets: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row_number within ``part_cols`` in ``order_cols`` order.

    ``order_cols`` must be a total order (end with a unique column). ``bucket``
    must be non-decreasing in that order (e.g. the top bits of the hash that
    leads the order); when None, range buckets of the first order column are used.
    """
    part = _cols(part_cols)
    order = _cols(order_cols)
    bcol = f"__{out}_b"
    d = _with_bucket(df, order, bcol, bucket, n_buckets)
    w = Window.partitionBy(*part, bcol).orderBy(*order)
    d = d.withColumn(f"__{out}_l", F.row_number().over(w))
    offs = _bucket_offsets(d, part, bcol, {f"__{out}_n": F.count(F.lit(1))})
    keys = [p if isinstance(p, str) else p for p in part] + [bcol]
    return (d.join(offs, on=keys, how="inner")
            .withColumn(out, (F.col(f"__{out}_l") + F.col(f"__{out}_n_off")).cast("bigint"))
            .drop(bcol, f"__{out}_l", f"__{out}_n_off"))


def rank_steps(df: DataFrame, part_col: str, order_cols, cuts: DataFrame, out: str = "step",
               bucket: Column | None = None, n_buckets: int | None = None) -> DataFrame:
    """Add ``out`` = how many of the part's ``cuts`` are less than the row's rank (see :func:`rank_within`).

    ``cuts`` has a row per part: ``part_col`` and an array ``cuts`` of ranks. Rows of a bucket that no cut
    falls into share their step, known from the counts of the buckets: only the few buckets
    with a cut inside are sorted and shuffled."""
    order = _cols(order_cols)
    bcol, t = f"__{out}_b", [f"__{out}_{c}" for c in ("start", "lo", "hi", "cuts")]
    start, lo, hi, mine = map(F.col, t)
    d = _with_bucket(df, order, bcol, bucket, n_buckets)
    earlier = Window.partitionBy(part_col).orderBy(bcol).rowsBetween(Window.unboundedPreceding, -1)
    table = (d.groupBy(part_col, bcol).agg(F.count(F.lit(1)).alias("__n"))
             .withColumn(t[0], F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
             .join(cuts.select(part_col, F.col("cuts").alias(t[3])), part_col)
             .withColumn(t[1], F.size(F.filter(mine, lambda c: c <= start)))
             .withColumn(t[2], F.size(F.filter(mine, lambda c: c < start + F.col("__n")))))  # parts x buckets
    d = lookup_small(d, table, [part_col, bcol], t)
    known = d.where(lo == hi).withColumn(out, lo)
    rank = start + F.row_number().over(Window.partitionBy(part_col, bcol).orderBy(*order))
    ranked = d.where(lo != hi).withColumn("__r", rank).withColumn(out, F.size(F.filter(mine, lambda c: c < F.col("__r"))))
    keep = [F.col(f"`{c}`") for c in [*df.columns, out]]
    return known.select(*keep).unionByName(ranked.select(*keep))


def running_sum(df: DataFrame, order_col: str, sum_cols: Sequence[str], part_cols=None,
                descending: bool = False, n_buckets: int | None = None,
                prefix: str = "cum_") -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` in ``order_col`` order
    within ``part_cols``. Order values must be unique within a part (aggregate by
    them first)."""
    part = _cols(part_cols)
    key = "__rs_key"
    d = df.withColumn(key, (-F.col(order_col) if descending else F.col(order_col)).cast("double"))
    bcol = "__rs_b"
    d = with_range_bucket(d, key, bcol, n_buckets)
    w = (Window.partitionBy(*part, bcol).orderBy(key)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in sum_cols:
        d = d.withColumn(f"__l_{c}", F.sum(c).over(w))
    offs = _bucket_offsets(d, part, bcol, {f"__t_{c}": F.sum(c) for c in sum_cols})
    d = d.join(offs, on=part + [bcol], how="inner")
    for c in sum_cols:
        d = d.withColumn(f"{prefix}{c}", F.col(f"__l_{c}") + F.col(f"__t_{c}_off"))
    return d.drop(key, bcol, *[f"__l_{c}" for c in sum_cols], *[f"__t_{c}_off" for c in sum_cols])


def next_values(df: DataFrame, order_col: str, cols: Sequence[str], part_cols=None, descending: bool = False,
                n_buckets: int | None = None, prefix: str = "next_") -> DataFrame:
    """Add ``next_<c>``: the value of ``c`` in the next row in ``order_col`` order within
    ``part_cols`` (null in the last row). Order values must be unique within a part.

    Range buckets are windowed on their own; the last row of a bucket takes the first row of the
    next bucket that has any, from a table of the buckets' first rows."""
    part = _cols(part_cols)
    key, bcol = "__nv_key", "__nv_b"
    d = df.withColumn(key, (-F.col(order_col) if descending else F.col(order_col)).cast("double"))
    d = with_range_bucket(d, key, bcol, n_buckets)
    row = F.struct(*cols)
    d = d.withColumn("__nv_in", F.lead(row).over(Window.partitionBy(*part, bcol).orderBy(key)))
    first = d.groupBy(*part, bcol).agg(F.min_by(row, F.col(key)).alias("__nv_f"))
    if part:
        w = Window.partitionBy(*part).orderBy(bcol)
        border = first.select(*part, bcol, F.lead("__nv_f").over(w).alias("__nv_out"))
    else:  # at most a row per bucket: the neighbours are paired on the driver
        rows = sorted(first.collect(), key=lambda r: (r[bcol] is None, r[bcol]))
        after = [r["__nv_f"] for r in rows[1:]] + [None]
        kind = first.schema["__nv_f"].dataType.simpleString()
        border = F.broadcast(df.sparkSession.createDataFrame(
            [(r[bcol], a) for r, a in zip(rows, after, strict=False)], f"{bcol} int, __nv_out {kind}"))
    d = d.join(border, on=[*part, bcol], how="inner").withColumn("__nv", F.coalesce("__nv_in", "__nv_out"))
    return d.select(*df.columns, *[F.col(f"__nv.{c}").alias(f"{prefix}{c}") for c in cols])
