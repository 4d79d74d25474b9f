"""Approximate nearest neighbours by bucketed random projections (T8, M5), exact in their distances.

A table of hashes maps a vector to ``floor((x . a + b) / width)`` for a few random
directions; near vectors share a bucket in some table with high probability.
Candidates are put into their bucket of every table, queries look into theirs and, per
direction, into the neighbour bucket on the nearer side. What meets is compared exactly:
a bucket with more rows than ``block_rows`` is cut into blocks of candidates and blocks of queries, each
pair one task, so nothing is dropped where rows are dense; queries that found
fewer than k candidates are searched exactly. The caller asks for this search; the number of
rows never does.

The width is four times the mean distance to the k-th neighbour of at most
``SAMPLE`` queries picked by hash, unless it is given.
"""

from __future__ import annotations

import math
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

from ..functions.hashing import hash32
from ..functions.rowwise import lookup_small
from ..session import staged
from .boosting import mix64
from .knn import DEFAULT_BLOCK_ROWS, _codes, _top, knn

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[knn.__module__])

TABLES, HASHES, SAMPLE = 6, 4, 64
SLOT_ROWS = 1 << 16  # rows of the buckets that one group compares


def buckets(x: np.ndarray, directions: np.ndarray, shift: np.ndarray, width: float, tables: int, probe: bool):
    """Bucket keys of each row, a column per table (and, when probing, per table and direction)."""
    at = x @ directions / width + shift
    code = np.floor(at)
    step = np.where(at - code < 0.5, -1, 1)
    code = code.astype(np.int64).reshape(len(x), tables, -1)
    step = step.reshape(code.shape)
    hashes = code.shape[2]
    out = []
    for move in [None, *range(hashes)] if probe else [None]:
        c = code.copy()
        if move is not None:
            c[:, :, move] += step[:, :, move]
        key = np.broadcast_to(mix64(np.arange(1, tables + 1, dtype=np.uint64)), c.shape[:2])
        for i in range(hashes):
            key = mix64(key ^ mix64(c[:, :, i].view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        out.append(key)
    return np.concatenate(out, axis=1).view(np.int64)


def _hashed(df: DataFrame, vec: str, dims: int, width: float, tables: int, hashes: int, seed: int, probe: bool) -> DataFrame:
    """Every row once per bucket (``bucket``); rows whose vector is not all numbers are in none."""
    r = np.random.default_rng(seed)
    directions, shift = r.standard_normal((dims, tables * hashes)), r.random(tables * hashes)
    at = df.columns.index(vec)

    def run(batches):
        for b in batches:
            vectors = b.column(at).to_pylist()
            good = [i for i, v in enumerate(vectors) if v is not None and len(v) == dims
                    and all(e is not None and math.isfinite(e) for e in v)]
            if not good:
                continue
            keys = buckets(np.array([vectors[i] for i in good], float), directions, shift, width, tables, probe)
            rows = pa.array(np.repeat(np.array(good), keys.shape[1]))
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in b.columns), pa.array(keys.ravel())], [*b.schema.names, "bucket"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{ddl}, bucket long")


def _dense(hashed: DataFrame, keys: list[str], block_rows: int, out: str) -> DataFrame:
    """Buckets of more than ``block_rows`` rows and their number of blocks."""
    n = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") > block_rows).select(*keys, F.ceil(F.col("n") / block_rows).cast("int").alias(out))


def runs(t: pa.Table, by: Sequence[str]) -> tuple[pa.Table, dict]:
    """The rows in order of the columns ``by``, and (start, length) of each of their values."""
    t = t.append_column("__at", pa.array(np.arange(t.num_rows)))
    n = t.group_by(list(by), use_threads=False).aggregate([("__at", "list")])
    at = n.column("__at_list").combine_chunks()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy())]).tolist() if len(at) else [0]
    keys = zip(*(n.column(c).to_pylist() for c in by))
    found = {k: (a, b - a) for k, a, b in zip(keys, ends[:-1], ends[1:], strict=True)}
    return t.drop_columns("__at").take(at.flatten()).combine_chunks(), found


def knn_lsh(queries: DataFrame, candidates: DataFrame, k: int, features: str = "features", id_col: str = "id",
            part_cols: Sequence[str] = (), exclude_self: bool = False, block_rows: int = DEFAULT_BLOCK_ROWS,
            carry: Sequence[str] = (), tables: int = TABLES, hashes: int = HASHES, width: float | None = None,
            seed: int = 1) -> DataFrame:
    """As :func:`knn.knn`, approximately: (part..., qid, cid, dist, carry..., nn_rank)."""
    part, carry, spark = list(part_cols), list(carry), queries.sparkSession
    number = F.monotonically_increasing_id()  # tells repeated ids apart; written once, so it stays
    q = staged(queries.select(*[F.col(p) for p in part], F.col(id_col).alias("qid"), F.col(features).alias("qf"),
                              number.alias("qn")), "lsh-queries")
    c = staged(candidates.select(*[F.col(p) for p in part], F.col(id_col).alias("cid"), F.col(features).alias("cf"),
                                 *[F.col(x).alias(f"__c_{x}") for x in carry], number.alias("cn")), "lsh-candidates")
    as_candidates = c.select(*part, F.col("cid").alias("id"), F.col("cf").alias("v"), *[F.col(f"__c_{x}").alias(x) for x in carry])

    def exact(some: DataFrame) -> DataFrame:
        return knn(some.select(*part, F.col("qn").alias("id"), F.col("qf").alias("v"), F.col("qid").alias("own")),
                   as_candidates.withColumn("own", F.col("id")), k + bool(exclude_self), "v", "id", part,
                   block_rows=block_rows, carry=[*carry, "own"])

    head = q.select(F.size("qf").alias("n")).where("n > 0").first()
    dims = head["n"] if head else 1
    if width is None:
        far = exact(q.orderBy(F.xxhash64("qid", "qn")).limit(SAMPLE)).where(F.col("nn_rank") == k + bool(exclude_self))
        width = 4.0 * (far.agg(F.avg("dist")).first()[0] or 0.25)
    hq = _hashed(q, "qf", dims, width, tables, hashes, seed, True)
    hc = _hashed(c, "cf", dims, width, tables, hashes, seed, False)
    keys = [*part, "bucket"]
    nq, nc = _dense(hq, keys, block_rows, "__nq"), _dense(hc, keys, block_rows, "__nc")
    hq, hc = (lookup_small(lookup_small(x, nq, keys, ["__nq"]), nc, keys, ["__nc"])
              .withColumns({n: F.coalesce(n, F.lit(1)) for n in ("__nq", "__nc")}) for x in (hq, hc))
    hq = (hq.withColumn("qb", (hash32("qb", F.col("qn")) % F.col("__nq")).cast("int"))
          .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("__nc") - 1))).drop("__nq", "__nc"))
    hc = (hc.withColumn("cb", (hash32("cb", F.col("cn")) % F.col("__nc")).cast("int"))
          .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("__nq") - 1))).drop("__nq", "__nc"))
    kinds = {f.name: f.dataType.simpleString() for f in (*q.schema.fields, *c.schema.fields)}
    names = [*part, "qid", "qn", "cid", "cn", *(f"__c_{x}" for x in carry)]
    schema = ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "dist double"])

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    by = [*keys, "qb", "cb"]

    def slot_topk(some: pa.Table, others: pa.Table) -> pa.Table:
        """The buckets of a slot one by one: a group of its own costs far more than a small bucket's work."""
        if not some.num_rows or not others.num_rows:
            return arrow.empty_table()
        (some, first), (others, second) = runs(some, by), runs(others, by)
        x, y = (np.array(t.column(n).to_pylist(), float) for t, n in ((some, "qf"), (others, "cf")))
        qcode, ccode = _codes(*(np.array(t.column(n).to_pylist()) for t, n in ((some, "qid"), (others, "cid"))))
        met = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
        for key, (a, n) in first.items():
            if key in second:
                b, m = second[key]
                qi, ci, dist = _top(x[a:a + n], y[b:b + m], qcode[a:a + n], ccode[b:b + m], k, exclude_self)
                met.append((qi + a, ci + b, dist))
        qi, ci, dist = (np.concatenate(v) for v in zip(*met, strict=True))
        at = [t.column(n).take(pa.array(i)) for t, i, own in ((some, qi, names[:len(part) + 2]), (others, ci, names[len(part) + 2:]))
              for n in own]
        return pa.Table.from_arrays([*at, pa.array(dist)], [*names, "dist"]).cast(arrow)

    # blocks of a dense bucket are dealt to different slots
    n = staged(hq.groupBy().agg(F.count(F.lit(1)).alias("q")).crossJoin(hc.groupBy().agg(F.count(F.lit(1)).alias("c"))),
               "lsh-rows").first()
    slots = int((n["q"] + n["c"]) // SLOT_ROWS) + int(spark.conf.get("spark.sql.shuffle.partitions"))
    hq, hc = (x.withColumn("slot", F.pmod(F.xxhash64(*by), F.lit(slots))) for x in (hq, hc))
    met = hq.groupBy("slot").cogroup(hc.groupBy("slot")).applyInArrow(slot_topk, schema)
    best = met.dropDuplicates(["qn", "cn"])
    w = Window.partitionBy("qn").orderBy("dist", "cid", "cn")  # at most k per bucket and block
    near = staged(best.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k), "lsh-near")
    found = near.groupBy("qn").agg(F.count(F.lit(1)).alias("__found"))
    few = staged(q.join(found, "qn", "left").where(F.coalesce("__found", F.lit(0)) < k).drop("__found"), "lsh-few")
    near = near.join(few.select("qn"), "qn", "left_anti").select(*part, "qid", "cid", "dist",
                                                                 *[F.col(f"__c_{x}").alias(x) for x in carry], "nn_rank")
    rest = exact(few).withColumnRenamed("qid", "qn").drop("nn_rank", "own").join(few.select("qn", "qid"), "qn")
    if exclude_self:
        rest = rest.where(F.col("qid") != F.col("cid"))
    rest = rest.withColumn("nn_rank", F.row_number().over(Window.partitionBy("qn").orderBy("dist", "cid")))
    return near.unionByName(rest.where(F.col("nn_rank") <= k).drop("qn").select(near.columns))


def search(neighbours: str):
    """The search by its name: ``exact`` or ``lsh``."""
    found = {"exact": knn, "lsh": knn_lsh}.get(neighbours)
    if found is None:
        raise ValueError(f"neighbours must be 'exact' or 'lsh', not {neighbours!r}")
    return found
