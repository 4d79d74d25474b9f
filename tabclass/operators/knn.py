"""Exact k-nearest neighbours (used by T8 and SMOTE, M5).

No pair table is ever emitted. Vectors of at most ``CELL_DIMS`` numbers are searched by
cells (:mod:`.knn_cells`): most candidates are too far from a query to be compared.
In more dimensions no cell can be passed over, and they are searched by blocks. Inside each group (optionally a class),
queries are cut into ceil(sqrt(n_queries / block_rows)) blocks and candidates
into ceil(sqrt(n_candidates / block_rows)); query rows are repeated once per
candidate block and candidate rows once per query block, so a block pair meets
in exactly one ``cogroup`` task. That task computes the distances in NumPy
chunks (matrix product, then exact distances of what may be among the k best)
and emits only its k best candidates per query. A last, small step keeps the k
best of the partial answers per query. Rows moved grow as n x sqrt(n /
block_rows); distance work is the inherent n^2 of exact search. Candidate
columns that the caller needs (label, vector) travel with the candidate, so
nothing is joined back and candidates may repeat an id.

Ties are broken by candidate id, so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..functions.rowwise import lookup_small
from ..session import staged

DEFAULT_BLOCK_ROWS = 4096
CELL_DIMS = 8


def _blocks(df: DataFrame, part: list[str], block_rows: int, out: str) -> DataFrame:
    """(part..., out): number of blocks per group, from group sizes (small table)."""
    return (df.groupBy(*part).agg(F.count(F.lit(1)).alias("__gn"))
            .select(*part, F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("__gn") / F.lit(float(block_rows)))))
                    .cast("int").alias(out)))


def _codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both id lists as ranks in their common order (ids of any sortable type)."""
    codes = pd.factorize(np.concatenate([a, b]), sort=True)[0]
    return codes[:len(a)], codes[len(a):]


def _top(X, Y, qcode, ccode, kk: int, exclude_self: bool):
    """(query row, candidate row, distance) of each query's ``kk`` nearest,
    nearest first, ties by candidate id. NaN distances are left out."""
    found = []
    ok = np.flatnonzero(np.isfinite(Y).all(axis=1))
    yy = np.einsum("ij,ij->i", Y[ok], Y[ok])
    step = max(1, 4_000_000 // max(1, len(ok)))
    for s in range(0, len(X) if len(ok) else 0, step):
        x = X[s:s + step]
        xx = np.einsum("ij,ij->i", x, x)
        near = xx[:, None] + yy[None, :] - 2.0 * (x @ Y[ok].T)
        if exclude_self:
            near[qcode[s:s + step, None] == ccode[None, ok]] = np.inf
        k_th = min(kk, len(ok)) - 1
        edge = np.partition(near, k_th, axis=1)[:, k_th]
        slack = 1e-9 * (xx + yy.max()) + 1e-12  # above the rounding error of the product
        qi, ci = np.nonzero((near <= (edge + slack)[:, None]) & np.isfinite(near))
        diff = x[qi] - Y[ok][ci]
        d2 = np.einsum("ij,ij->i", diff, diff)
        order = np.lexsort((ccode[ok][ci], d2, qi))
        qi, ci, d2 = qi[order], ci[order], d2[order]
        first = np.searchsorted(qi, qi)
        take = np.arange(len(qi)) - first < kk
        found.append((qi[take] + s, ok[ci[take]], np.sqrt(d2[take])))
    if not found:
        return np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def knn(queries: DataFrame, candidates: DataFrame, k: int, features: str = "features",
        id_col: str = "id", part_cols: Sequence[str] = (), exclude_self: bool = False,
        block_rows: int = DEFAULT_BLOCK_ROWS, carry: Sequence[str] = ()) -> DataFrame:
    """k nearest candidates (Euclidean) of every query row.

    ``features`` is an array<double> column in both frames; ``part_cols`` limit
    neighbours to the same group (e.g. the class for SMOTE); ``carry`` are
    candidate columns returned with the neighbour. Ids may be of any sortable
    type. Returns (part..., qid, cid, dist, carry..., nn_rank) with nn_rank 1..k.
    """
    part, carry = list(part_cols), list(carry)
    # fresh aliases: queries and candidates may share lineage (SMOTE: both from one frame)
    q = queries.select(*[F.col(p).alias(p) for p in part], F.col(id_col).alias("qid"),
                       F.col(features).alias("qf"))
    c = candidates.select(*[F.col(p).alias(p) for p in part], F.col(id_col).alias("cid"),
                          F.col(features).alias("cf"), *[F.col(x).alias(f"__c_{x}") for x in carry])
    q, c = staged(q, "knn-q"), staged(c, "knn-c")  # read several times
    head = q.select(F.size("qf").alias("n")).where("n > 0").first()
    w = Window.partitionBy(*part, "qid").orderBy("dist", "cid")
    if head is not None and head["n"] <= CELL_DIMS:
        from .knn_cells import CELL_ROWS, knn_by_cells
        finite = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))
        found = knn_by_cells(q.where(F.forall("qf", finite)), c.where(F.forall("cf", finite)), k, head["n"], part,
                             exclude_self, carry, min(block_rows, CELL_ROWS))
        return found.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    nq, nc = _blocks(q, part, block_rows, "__nq"), _blocks(c, part, block_rows, "__nc")
    if part:
        q, c = (lookup_small(lookup_small(x, nq, part, ["__nq"]), nc, part, ["__nc"]) for x in (q, c))
    else:
        blocks = {"__nq": F.lit(int(nq.first()["__nq"])), "__nc": F.lit(int(nc.first()["__nc"]))}
        q, c = q.withColumns(blocks), c.withColumns(blocks)
    one = F.lit(1)
    q = (q.withColumn("qb", (hash32("qb", F.col("qid")) % F.coalesce("__nq", one)).cast("int"))
         .withColumn("cb", F.explode(F.sequence(F.lit(0), F.coalesce("__nc", one) - 1))).drop("__nq", "__nc"))
    c = (c.withColumn("cb", (hash32("cb", F.col("cid")) % F.coalesce("__nc", one)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.coalesce("__nq", one) - 1))).drop("__nq", "__nc"))
    keys = part + ["qb", "cb"]
    fields = [*queries.select(*part).schema.fields]
    kinds = {f.name: f.dataType.simpleString() for f in (*q.schema.fields, *c.schema.fields)}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                        f"qid {kinds['qid']}, cid {kinds['cid']}, dist double",
                        *(f"`{x}` {kinds[f'__c_{x}']}" for x in carry)])
    kk = k

    def block_topk(key, qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        out = {p: [] for p in part} | {"qid": [], "cid": [], "dist": []} | {x: [] for x in carry}
        if len(qpdf) and len(cpdf):
            X = np.stack(qpdf["qf"].map(lambda a: np.asarray(a, dtype=np.float64)).to_numpy())
            Y = np.stack(cpdf["cf"].map(lambda a: np.asarray(a, dtype=np.float64)).to_numpy())
            qcode, ccode = _codes(qpdf["qid"].to_numpy(), cpdf["cid"].to_numpy())
            qi, ci, dist = _top(X, Y, qcode, ccode, kk, exclude_self)
            out = {p: [key[j]] * len(qi) for j, p in enumerate(part)}
            out |= {"qid": qpdf["qid"].to_numpy()[qi], "cid": cpdf["cid"].to_numpy()[ci], "dist": dist}
            out |= {x: cpdf[f"__c_{x}"].to_numpy()[ci] for x in carry}
        return pd.DataFrame(out)

    partial = (q.groupBy(*keys).cogroup(c.groupBy(*keys))
               .applyInPandas(block_topk, schema=schema))
    return (partial.withColumn("nn_rank", F.row_number().over(w))
            .where(F.col("nn_rank") <= k))


def knn_classify(train: DataFrame, test: DataFrame, k: int = 3, features: str = "features",
                 id_col: str = "id", label: str = "target",
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Label of each test row by vote of its k nearest train rows; ties go
    to the smallest label (one-vs-rest over kNN reduces to this vote)."""
    nn = knn(test, train, k, features, id_col, block_rows=block_rows, carry=[label])
    votes = nn.groupBy("qid", F.col(label).alias("nl")).agg(F.count(F.lit(1)).alias("v"))
    best = votes.groupBy("qid").agg(F.min(F.struct((-F.col("v")).alias("nv"), F.col("nl").alias("l")))
                                    .alias("b"))
    return best.select(F.col("qid").alias(id_col), F.col("b.l").alias("pred"))
