"""Running counts of a job's scores (E10-E13) from sorted chunks.

A row of every set has a score per class, so the counts by (set, class, score) are several times the
rows, nearly all distinct. Here they travel as chunks: a task sorts some hundred thousand rows' scores of
one class, joins equal ones and cuts them at the bounds of the class's score ranges. The chunks' totals give
what lies in higher ranges; the chunks of a range meet in one group, which merges them and runs along.
A score that many rows share is one entry of a chunk.

The bounds come from a few hundred rows a range, drawn by a seed; they balance the ranges only: every row is counted.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.rowwise import qcol
from ..session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 1 << 18  # rows whose scores a task sorts at once
RANGE_ROWS = 1 << 19  # scores of a class that one group merges
BOUND_ROWS = 400      # drawn per range for its bounds
CHUNK = "`set` string, cls string, bucket int, n_pos long, n_neg long, scores binary, pos binary, neg binary"
POINT = ("`set` string, cls string, score double, pos long, neg long, cum_pos long, cum_neg long, P long, N long, "
         "area double")


def _joined(s: np.ndarray, pos: np.ndarray, neg: np.ndarray):
    """From the highest score down, equal scores as one with their counts added; NaN last."""
    order = np.argsort(-s)
    s, pos, neg = s[order], pos[order], neg[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) & ~(np.isnan(s[1:]) & np.isnan(s[:-1]))
    at = np.flatnonzero(new)
    return s[at], np.add.reduceat(pos, at), np.add.reduceat(neg, at)


def score_bounds(rows: DataFrame, classes: Sequence[str], sizes: dict[str, int]) -> dict[tuple[str, str], list[float]]:
    """By (set, class): descending scores that cut it into ranges of about ``RANGE_ROWS`` rows; ``sizes``: rows by set."""
    parts = {s: -(-n // RANGE_ROWS) for s, n in sizes.items()}
    out = {(s, c): [] for s in sizes for c in classes}
    if not parts or max(parts.values()) < 2:
        return out
    share = {s: min(1.0, BOUND_ROWS * b / sizes[s]) if b > 1 else 0.0 for s, b in parts.items()}
    most = max(parts.values())
    at = [i / (4 * most) for i in range(1, 4 * most)]  # finer than needed: every set takes its own
    some = rows.sampleBy("set", share, 1).groupBy("set").agg(*[
        F.percentile_approx(F.nanvl(qcol(c).cast("double"), F.lit(None)), at, 10 * len(at)).alias(f"b{i}")
        for i, c in enumerate(classes)]).collect()  # sets x classes x ranges
    for r in some:
        for i, c in enumerate(classes):
            b, n = r[f"b{i}"], parts[r["set"]]
            if b and n > 1:
                out[(r["set"], c)] = sorted({float(b[len(b) * j // n]) for j in range(1, n)}, reverse=True)
    return out


def score_chunks(rows: DataFrame, classes: Sequence[str], bounds: dict[tuple[str, str], list[float]]) -> DataFrame:
    """``set, cls, bucket`` and, of some rows' scores in that range, the totals and the distinct scores with their
    positives and negatives. Null scores and NaN have ranges of their own, in this order below all others; a row without
    a label is neither positive nor negative."""
    d = rows.select("set", "actual", *[qcol(c).cast("double").alias(f"__s{i}") for i, c in enumerate(classes)])
    schema = to_arrow_schema(StructType.fromDDL(CHUNK))

    def cut(t: pa.Table):
        sets, labels = (t.column(n).combine_chunks().dictionary_encode() for n in ("set", "actual"))
        of_set, of_label = (np.asarray(x.indices.fill_null(-1)) for x in (sets, labels))
        names = labels.dictionary.to_pylist()
        for i, name in enumerate(sets.dictionary.to_pylist()):
            mine = np.flatnonzero(of_set == i)
            for j, c in enumerate(classes):
                col = t.column(f"__s{j}").combine_chunks()
                s = np.asarray(col.fill_null(0.0))[mine] + 0.0  # -0.0 is 0.0
                null = np.asarray(pc.is_null(col))[mine]
                y = of_label[mine]
                pos = (y == (names.index(c) if c in names else -2)).astype(np.int64)
                neg = (y >= 0).astype(np.int64) - pos
                b = -np.array(bounds[(name, c)], float)
                nan = np.isnan(s)
                for bucket, sel in ((None, ~null & ~nan), (len(b) + 1, null), (len(b) + 2, nan)):
                    if not sel.any():
                        continue
                    u, p, q = _joined(s[sel], pos[sel], neg[sel])
                    ends = [0, *np.searchsorted(-u, b, "right"), len(u)] if bucket is None else [0, len(u)]
                    for k, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)):
                        if hi > lo:
                            yield (name, c, k if bucket is None else bucket, int(p[lo:hi].sum()), int(q[lo:hi].sum()),
                                   u[lo:hi].tobytes(), p[lo:hi].tobytes(), q[lo:hi].tobytes())

    def run(batches):
        held, n = [], 0

        def out():
            for r in cut(pa.Table.from_batches(held)):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(r, schema, strict=True)], schema=schema)

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= CHUNK_ROWS:
                yield from out()
                held, n = [], 0
        if n:
            yield from out()

    return d.mapInArrow(run, CHUNK)


def running_points(rows: DataFrame, classes: Sequence[str], sizes: dict[str, int], first: str) -> DataFrame:
    """``set, cls, score, pos, neg, cum_pos, cum_neg, P, N`` per distinct score of the class ``first``, as
    ``curves.running_counts`` has them; and for every class, in rows without ``pos``, shares ``area`` of the sum
    whose total over ``P * N`` is the area under its curve."""
    bounds = score_bounds(rows, classes, sizes)
    chunks = staged(score_chunks(rows, classes, bounds), "score-chunks", **{"parquet.block.size": 16 << 20})
    keys = ["set", "cls"]
    higher = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    totals = chunks.groupBy(*keys, "bucket").agg(F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
    totals = totals.select(*keys, "bucket", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"before_{c}") for c in "pn"],
                           F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N"))
    null_bucket = {k: len(b) + 1 for k, b in bounds.items()}
    schema = to_arrow_schema(StructType.fromDDL(POINT))

    def merge(t: pa.Table) -> pa.Table:
        of = {c: t.column(c)[0].as_py() for c in ("set", "cls", "bucket", "before_p", "before_n", "P", "N")}
        s, pos, neg = (np.frombuffer(b"".join(x.as_buffer() for x in t.column(c)), kind)
                       for c, kind in (("scores", np.float64), ("pos", np.int64), ("neg", np.int64)))
        s, pos, neg = _joined(s, pos, neg)
        cum_pos, cum_neg = of["before_p"] + np.cumsum(pos), of["before_n"] + np.cumsum(neg)
        area = float((pos * (of["N"] - cum_neg + neg / 2.0)).sum())
        n = len(s) if of["cls"] == first else 0
        total = pa.table([[of["set"]], [of["cls"]], [None], [None], [None], [None], [None], [of["P"]], [of["N"]], [area]],
                         schema=schema)
        if not n:
            return total
        null = np.full(n, of["bucket"] == null_bucket[(of["set"], of["cls"])])
        points = [pa.array([of["set"]] * n), pa.array([of["cls"]] * n), pa.array(s, mask=null), pos, neg, cum_pos, cum_neg,
                  np.full(n, of["P"]), np.full(n, of["N"]), pa.nulls(n, pa.float64())]
        return pa.concat_tables([total, pa.table(points, schema=schema)])

    met = chunks.drop("n_pos", "n_neg").join(F.broadcast(totals), [*keys, "bucket"])  # sets x classes x ranges rows
    return met.groupBy(*keys, "bucket").applyInArrow(merge, POINT)
