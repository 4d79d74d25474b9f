"""SimHash near-duplicates by vantage-point trees.

Every text becomes a 64-bit majority fingerprint of its word shingles; equal
fingerprints are one point. Points within ``radius`` differing bits are linked,
and a document's component is everything reachable.

Vantage-point tree: a node takes a point v and the median mu of the distances
to v. Its near branch holds the points with d <= mu, its far branch those with
d > mu - radius: by the triangle bound |d(x) - d(y)| <= d(x, y), two points
within the radius are together in the near or in the far branch, so no link is
lost and only the points at the boundary are in both. The upper tree is built
from a bounded sample (``SAMPLE`` points; it only decides how the points are
cut, every point goes through it) and cuts the points into shards that overlap
at their boundaries; each shard builds the rest of the tree by itself. Where a
ball is too dense to be cut, small sets are compared in blocks and large ones
look up all fingerprints at the radius, which is linear.

A shard returns a spanning forest of its links, never all pairs of a group; the
forests are joined by alternating large-star and small-star steps, each written
to the shared folder.

Defined results: a null or wordless text has fingerprint 0, linked like any
other; fewer words than a shingle make one shingle; repeated rows are repeated;
a null id never names a component unless all its ids are null; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, staged
from .graph import components

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD = 8192      # points aimed at in a shard
SAMPLE = 65536    # points that shape the upper tree, at most
LEAF = 128
DENSE = 20000     # undivided sets above this size are searched by look-up


# ------------------------------------------------------------ fingerprints
def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate((len(w) + 1 for w in words)))
        starts = [0, *ends[:len(words) - shingle]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long)."""
    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp long")


# ------------------------------------------------------- vantage-point tree
def distance(x: np.ndarray, v) -> np.ndarray:
    return np.bitwise_count(x ^ v).astype(np.int16)


def split(x: np.ndarray, radius: int):
    """(vantage, mu) that cuts ``x``, or None where the ball is too dense."""
    best = None
    for v in (x[0], x[len(x) // 2], x[-1]):
        d = distance(x, v)
        mu = int(np.median(d))
        worst = max(int((d <= mu).sum()), int((d > mu - radius).sum()))
        if best is None or worst < best[0]:
            best = (worst, v, mu)
    return (best[1], best[2]) if best[0] <= 0.75 * len(x) else None


def upper_tree(sample: np.ndarray, depth: int, radius: int) -> list:
    """Nodes ``[vantage, mu, near, far]`` or ``[shard]``, the root first."""
    nodes: list = []

    def grow(x, depth):
        at = len(nodes)
        nodes.append(None)
        cut = split(x, radius) if depth > 0 and len(x) >= 16 else None
        if cut is None:
            nodes[at] = [at]
        else:
            d = distance(x, cut[0])
            nodes[at] = [cut[0], cut[1], grow(x[d <= cut[1]], depth - 1), grow(x[d > cut[1] - radius], depth - 1)]
        return at

    grow(sample, depth)
    return nodes


def route(x: np.ndarray, nodes: list, radius: int):
    """(shard, points) of every shard that points of ``x`` fall into."""
    todo = [(0, x)]
    while todo:
        at, part = todo.pop()
        if not len(part):
            continue
        node = nodes[at]
        if len(node) == 1:
            yield at, part
        else:
            d = distance(part, node[0])
            todo += [(node[2], part[d <= node[1]]), (node[3], part[d > node[1] - radius])]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` points over the links (a, b)."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]


def shard_links(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of ``x`` (distinct, sorted) with links, and each one's first
    reachable point: a spanning forest of all links within the radius."""
    heads, tails, held = [], [], 0
    todo = [np.arange(len(x))]

    def shrink():
        nonlocal heads, tails, held
        root = forest(len(x), np.concatenate(heads), np.concatenate(tails))
        linked = np.flatnonzero(root != np.arange(len(x)))
        heads, tails, held = [linked], [root[linked]], len(linked)

    def add(i, j):
        nonlocal held
        heads.append(i)
        tails.append(j)
        held += len(i)
        if held > 1_000_000:
            shrink()

    while todo:
        part = todo.pop()
        cut = split(x[part], radius) if len(part) > LEAF else None
        if cut is not None:
            d = distance(x[part], cut[0])
            todo += [part[d <= cut[1]], part[d > cut[1] - radius]]
        elif len(part) <= DENSE:
            y = x[part]
            for k in range(0, len(part), LEAF):  # blocks against all that follow
                i, j = np.nonzero(np.bitwise_count(y[k:k + LEAF, None] ^ y[None, k:]) <= radius)
                i, j = i[i < j], j[i < j]
                add(part[i + k], part[j + k])
        else:
            y = x[part]  # sorted: look up every fingerprint at the radius
            flips = [0]
            for _ in range(radius):
                flips = sorted({f ^ (1 << s) for f in flips for s in range(64)} | set(flips))
            for f in flips[1:]:
                z = y ^ np.uint64(f)
                at = np.minimum(np.searchsorted(y, z), len(y) - 1)
                hit = np.flatnonzero(y[at] == z)
                add(part[hit], part[at[hit]])
    if not heads:
        return x[:0], x[:0]
    shrink()
    return x[heads[0]], x[tails[0]]


def links(points: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``a, b``: spanning links between distinct fingerprints (column ``fp``)."""
    spark, n = points.sparkSession, points.count()
    picked = points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect() if n > shard else []
    s = np.array([r[0] for r in picked], dtype=np.int64).view(np.uint64)
    nodes = upper_tree(s, max(0, int(np.ceil(np.log2(max(n, 1) / shard)))), radius)

    def deal(batches):
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at, part in route(x, nodes, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), at, dtype=np.int64)), pa.array(part.view(np.int64))], ["shard", "fp"])

    def search(table: pa.Table) -> pa.Table:
        x = np.sort(table.column("fp").to_numpy().view(np.uint64))
        a, b = shard_links(x, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = points.select("fp").mapInArrow(deal, "shard long, fp long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(max(parts, n // shard), "shard")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long")


def near_groups(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, radius: int = RADIUS,
                shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, fp, component_id`` for each document."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    points = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-points")
    roots = components(staged(links(points, radius, shard, sample), "simhash-links"), "simhash-cc")
    named = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    label = named.join(least, "root").select("fp", "component_id")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def drop_near(docs: DataFrame, id_col="doc_id", text_col="text", **args) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.
    Rows are told apart by a row number of their own, so no component is lost
    where an id is repeated or null (a null id counts as the largest)."""
    rid, key = fresh(docs, "rid", "row_key")
    rows = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "simhash-rows")
    keyed = rows.withColumn(key, F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("doc_id"),
                                          F.col(rid).alias("rid")))
    g = near_groups(keyed, key, text_col, **args)
    gone = g.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.rid").alias(rid))
    return rows.join(gone, rid, "left_anti").select(*docs.columns)
