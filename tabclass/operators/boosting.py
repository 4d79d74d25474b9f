"""Histogram gradient boosting for several classes (T6) and its loss by tree.

Second-order boosting with the soft-max objective: a tree per class and round,
grown level by level from (tree, node, feature, bin) -> (gradient, hessian) sums,
with L1 / L2 leaf weights, a least gain, a least hessian per child, rows and
features drawn per tree: every parameter of the search space takes effect.

How a level runs: features are bins of one byte (at most 256 cut by quantiles, or every
distinct value where they are few). A task routes its rows through the trees of the
round, adds their gradients into dense NumPy histograms and emits one row per
non-empty (tree, node, feature, bin); Spark sums them, a window over the bins of a
feature gives every split's gain, and the driver gets one row per open node. What a
task emits is bounded by the model (nodes x features x bins), not by its rows.

The rows are packed into chunks once: in a chunk, rows of the same bins, label and weight
follow each other. Margins, gradients and nodes are those of the distinct ones; a
row by itself only has its hash, which a tree's draw needs. Where all rows differ, a
chunk has an entry a row, and nothing is lost but the order.

Several parameter sets over the same rows (a search's draws) are boosted together:
one pass a level serves all of them.

Gradients are summed as whole numbers (units of 2^-24), so a sum does not depend on
the order of rows or partitions: a re-run, or another number of executors,
gives the same trees. Weights count as copies of a row. Margins are written to the
shared folder every ``STAGE`` rounds, and a pass adds the few trees since then: the
lineage stays short, and a lost executor costs one pass over its rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.sinks import drop_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks get the functions themselves

MAX_BINS = 256
UNIT = float(1 << 24)   # gradients are whole numbers of this many parts
LEAST_GAIN = 1e-6       # a split must gain more than this
LEAST_HESSIAN = 1e-16
STAGE = 16              # rounds between two written margin tables
HIST_ROWS = 200_000     # histogram rows per reducing task
LOSS_EPS = 1e-16
CHUNK = 4 << 20         # bytes of a chunk whose rows all differ
PACKED = "bins binary, label binary, weight binary, starts binary, row_hash binary, margins binary"


@dataclass(frozen=True)
class BoostParams:
    """Parameters under the names of the search space, with that library's defaults."""
    learning_rate: float = 0.3
    n_estimators: int = 100
    max_depth: int = 6
    gamma: float = 0.0
    colsample_bytree: float = 1.0
    subsample: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0

    @classmethod
    def of(cls, params: dict | None) -> BoostParams:
        known = {f.name: f.type for f in fields(cls)}
        unknown = set(params or {}) - set(known)
        if unknown:
            raise ValueError(f"unknown boosting parameters: {sorted(unknown)}")
        return cls(**{k: int(v) if known[k] == "int" else float(v) for k, v in (params or {}).items()})


# ------------------------------------------------------------------- trees
class Tree:
    """Nodes in arrays: ``feature`` (-1: a leaf), ``cut`` (bins up to it go left), ``left`` (the
    right child follows it), ``value``."""

    def __init__(self):
        self.feature, self.cut, self.left, self.value, self.gain = [-1], [0], [0], [0.0], [0.0]

    def split(self, node: int, feature: int, cut: int, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, at, gain
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(v)
            self.gain.append(0.0)
        return at, at + 1

    def arrays(self):
        return (np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.value))


def route(bins: np.ndarray, tree) -> np.ndarray:
    """The node each row (of one-byte bins) ends in."""
    feature, cut, left, _ = tree
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while True:
        f = feature[node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        if not len(rows):
            return node
        at = node[rows]
        node[rows] = left[at] + (bins[rows, f] > cut[at])


def soft_max(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(row_hash: np.ndarray, rate: float, seed: int, tree: int) -> np.ndarray:
    """Whether each row is drawn for a tree."""
    salt = mix64(np.array([seed, tree], np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    u = mix64(row_hash ^ salt[0] ^ mix64(salt[1:])[0])
    return u < np.uint64(min(int(rate * 2.0 ** 64), 2 ** 64 - 1))


def tree_features(n: int, rate: float, seed: int, tree: int) -> np.ndarray:
    """The features a tree may split on: at least one, in order."""
    u = mix64(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix64(np.array([seed * 1_000_003 + tree + 1], np.uint64)))
    return np.sort(np.argsort(u, kind="stable")[:max(1, int(rate * n))])


def leaf(g, h, p: BoostParams) -> float:
    """Weight of a leaf with these sums (times the learning rate)."""
    w = max(abs(g) - p.reg_alpha, 0.0)
    return -math.copysign(w, g) / (h + p.reg_lambda) * p.learning_rate if h + p.reg_lambda > 0 else 0.0


# -------------------------------------------------------------------- bins
def feature_cuts(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Cut values of each numeric column: bin b holds the values from cut b-1
    up to, not including, cut b. Every distinct value is a bin where they are
    few, else quantiles (one pass for all columns; at most ``max_bins`` numbers
    a column reach the driver)."""
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be 2 to {MAX_BINS}: a bin is one byte")
    cols = [F.col(f"`{c}`").cast("double") for c in features]
    est = df.agg(*[F.approx_count_distinct(c, 0.01).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    few = [i for i in range(len(cols)) if est[i] <= 1.1 * max_bins]
    values: dict[int, list[float]] = {}
    if few:
        pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), cols[i].alias("v")) for i in few]))
        for r in df.select(pairs).where("v IS NOT NULL").distinct().collect():  # about max_bins rows a column
            values.setdefault(r["i"], []).append(r["v"])
    many = [i for i in range(len(cols)) if i not in few or len(values.get(i, ())) > max_bins]
    if many:
        at = [b / max_bins for b in range(1, max_bins)]
        row = df.agg(*[F.percentile_approx(cols[i], [0.0, *at], 20 * max_bins).alias(f"q{i}") for i in many]).first()
        values |= {i: list(row[f"q{i}"] or []) for i in many}
    return [np.array(sorted(set(values.get(i, [])))[1:]) for i in range(len(cols))]


def binned(df: DataFrame, cuts: list[np.ndarray], features_col: str = "features", label_col: str = "label",
           weight_col: str | None = None, id_col: str | None = "id", carry: Sequence[str] = ()) -> DataFrame:
    """``bins, label, weight, row_hash`` (and ``carry``): a byte per feature."""
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    h = F.xxhash64(F.col(id_col).cast("string")) if id_col else F.xxhash64(features_col)
    d = df.select(F.col(features_col).alias("x"), F.col(label_col).cast("int").alias("label"), w.alias("weight"),
                  h.alias("row_hash"), *carry)

    def run(batches):
        for b in batches:
            x = matrix(b.column(0), len(cuts))
            out = to_bins(x, cuts)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in out], pa.binary()), *b.columns[1:]],
                                             ["bins", *b.schema.names[1:]])

    tail = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[1:])
    return d.mapInArrow(run, f"bins binary, {tail}")


def matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, all of one length."""
    values = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).reshape(-1, width)


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(x.shape, np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.searchsorted(c, x[:, i], side="right")
    return out


# ------------------------------------------------------------------ growing
@dataclass
class Spec:
    """A parameter set being boosted: its trees by round and class, its first margin column."""
    params: BoostParams
    seed: int
    first: int
    trees: list


def gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number gradients and hessians of the soft-max loss, a column a class."""
    p = soft_max(margins)
    g = p.copy()
    g[np.arange(len(label)), label] -= 1.0
    return np.rint(g * UNIT), np.rint(np.maximum(2.0 * p * (1.0 - p), LEAST_HESSIAN) * UNIT)


def with_trees(margins: np.ndarray, bins: np.ndarray, recent) -> np.ndarray:
    """Margins after the trees ``recent``: (margin column, tree arrays)."""
    out = margins.copy()
    for column, tree in recent:
        out[:, column] += tree[3][route(bins, tree)]
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of bytes: the order that puts equal rows together, and where each distinct one starts in it."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.ascontiguousarray(keys).view(np.dtype((np.void, keys.shape[1]))).ravel()
    order = np.argsort(rows, kind="stable")
    there = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], (there[1:] != there[:-1]).any(axis=1)]))


def pack(data: DataFrame, n_features: int, width: int) -> DataFrame:
    """The rows of :func:`binned` in chunks (``PACKED``), margins zero."""
    size = max(1, CHUNK // (8 * width + n_features + 28))

    def chunk(parts):
        bins, label, weight, row_hash = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, starts = distinct(np.concatenate([bins, label[:, None].view(np.uint8), weight[:, None].view(np.uint8)], axis=1))
        first = order[starts]
        held = (bins[first], label[first], weight[first], starts, row_hash[order], np.zeros((len(first), width)))
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in held],
                                          ["bins", "label", "weight", "starts", "row_hash", "margins"])

    def run(batches):
        parts, n = [], 0
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                b = whole.slice(at, size - n)
                at, n = at + b.num_rows, n + b.num_rows
                parts.append((np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(-1, n_features),
                              b.column("label").to_numpy().astype(np.int32), b.column("weight").to_numpy(zero_copy_only=False),
                              b.column("row_hash").to_numpy()))
                if n == size:
                    yield chunk(parts)
                    parts, n = [], 0
        if parts:
            yield chunk(parts)

    return data.select("bins", "label", "weight", "row_hash").mapInArrow(run, PACKED)


def chunks(b: pa.RecordBatch, n_features: int, width: int):
    """(bins, label, weight, starts, row_hash, margins) of each chunk; rows are drawn by their hash, all else is distinct."""
    kinds = {"bins": np.uint8, "label": np.int32, "weight": np.float64, "starts": np.int64, "row_hash": np.uint64,
             "margins": np.float64}
    for i in range(b.num_rows):
        x = {name: np.frombuffer(b.column(name)[i].as_buffer(), kind) for name, kind in kinds.items()}
        yield (x["bins"].reshape(-1, n_features), x["label"], x["weight"], x["starts"], x["row_hash"],
               x["margins"].reshape(-1, width))


@dataclass
class Growing:
    """A tree of the present round as a task needs it."""
    number: int          # for the draws: round * classes + class
    spec: int
    cls: int
    tree: tuple
    place: np.ndarray    # node -> place among the level's open nodes, or -1
    features: np.ndarray
    rate: float
    seed: int


def level_histograms(growing: list[Growing], first_columns: list[int], n_classes: int, n_features: int,
                     n_bins: int, width: int, recent):
    """Batches of rows -> (tree, place, feature, bin, g, h) of the open nodes."""

    def run(batches):
        sums = [np.zeros((2, (t.place.max() + 1) * len(t.features) * n_bins)) for t in growing]
        for bins, label, weight, starts, row_hash, margins in (c for b in batches for c in chunks(b, n_features, width)):
            margins = with_trees(margins, bins, recent)
            every = np.diff(starts, append=len(row_hash))
            by_spec: dict[int, tuple] = {}
            for t, s in zip(growing, sums, strict=True):
                if t.spec not in by_spec:
                    first = first_columns[t.spec]
                    by_spec[t.spec] = gradients(margins[:, first:first + n_classes], label)
                g, h = by_spec[t.spec]
                at = t.place[route(bins, t.tree)]
                copies = every
                if t.rate < 1.0:
                    copies = np.add.reduceat(drawn(row_hash, t.rate, t.seed, t.number).view(np.uint8), starts, dtype=np.int64)
                rows = np.flatnonzero((at >= 0) & (weight > 0) & (copies > 0))
                k = len(t.features)
                cell = ((at[rows, None] * k + np.arange(k)) * n_bins + bins[rows][:, t.features]).ravel()
                for i, v in enumerate((g, h)):
                    s[i] += np.bincount(cell, np.repeat(v[rows, t.cls] * weight[rows] * copies[rows], k), s.shape[1])
        for i, (t, s) in enumerate(zip(growing, sums, strict=True)):
            full = np.flatnonzero((s[0] != 0) | (s[1] != 0))
            if len(full):
                k = len(t.features)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), i), pa.int32()), pa.array(full // n_bins // k, pa.int32()),
                     pa.array(t.features[full // n_bins % k], pa.int32()), pa.array(full % n_bins, pa.int32()),
                     pa.array(s[0][full].astype(np.int64)), pa.array(s[1][full].astype(np.int64))],
                    ["tree", "place", "feature", "bin", "g", "h"])

    return run


def best_splits(histograms: DataFrame, params: list[BoostParams], parts: int) -> DataFrame:
    """``tree, place, all_g, all_h, best`` (struct gain, nf, nb, g, h: the left sums): for each open node the split of
    the largest gain; ties go to the first feature, then the lowest bin."""
    def per_tree(name):
        return f"element_at(array({', '.join(f'{float(getattr(p, name))!r}D' for p in params)}), tree + 1)"

    def score(g, h):
        return f"pow(greatest(abs({g}) - alpha, 0D), 2) / ({h} + lam)"

    # as SQL text: one call to the JVM a step, for this runs once a level
    h = (histograms.repartition(parts, "tree", "place", "feature").groupBy("tree", "place", "feature", "bin")
         .agg(F.expr("sum(g) AS g"), F.expr("sum(h) AS h")))
    over = "OVER (PARTITION BY tree, place, feature"
    up_to = f"{over} ORDER BY bin ROWS UNBOUNDED PRECEDING)"
    h = h.selectExpr("tree", "place", "feature", "bin", f"sum(g) {up_to} / {UNIT!r}D AS lg", f"sum(h) {up_to} / {UNIT!r}D AS lh",
                     f"sum(g) {over}) / {UNIT!r}D AS ag", f"sum(h) {over}) / {UNIT!r}D AS ah")
    h = h.selectExpr("*", "ag - lg AS rg", "ah - lh AS rh", f"{per_tree('reg_alpha')} AS alpha",
                     f"{per_tree('reg_lambda')} AS lam", f"{per_tree('min_child_weight')} AS least")
    h = h.selectExpr("tree", "place", "ag", "ah", f"""struct(
        CASE WHEN lh > 0 AND rh > 0 AND lh >= least AND rh >= least
             THEN {score('lg', 'lh')} + {score('rg', 'rh')} - {score('ag', 'ah')} ELSE double('-infinity') END AS gain,
        -feature AS nf, -bin AS nb, lg AS g, lh AS h) AS best""")
    return h.groupBy("tree", "place").agg(F.expr("first(ag) AS all_g"), F.expr("first(ah) AS all_h"), F.expr("max(best) AS best"))


def grow_round(data: DataFrame, specs: list[Spec], live: list[int], rnd: int, n_classes: int, n_features: int,
               n_bins: int, width: int, recent) -> None:
    """One more tree per class for each live spec: a pass over the rows a level."""
    trees = [(s, c, Tree(), {0: None}) for s in live for c in range(n_classes)]
    firsts = [s.first for s in specs]
    for level in range(max(specs[s].params.max_depth for s in live)):
        growing, owners = [], []
        for s, c, tree, open_ in trees:
            spec = specs[s]
            if not open_ or level >= spec.params.max_depth:
                continue
            place = np.full(len(tree.feature), -1)
            nodes = sorted(open_)
            place[nodes] = np.arange(len(nodes))
            number = rnd * n_classes + c
            growing.append(Growing(number, s, c, tree.arrays(), place,
                                   tree_features(n_features, spec.params.colsample_bytree, spec.seed, number),
                                   spec.params.subsample, spec.seed))
            owners.append((s, tree, open_, nodes))
        if not growing:
            break
        rows = sum((g.place.max() + 1) * len(g.features) for g in growing) * n_bins
        hist = data.mapInArrow(level_histograms(growing, firsts, n_classes, n_features, n_bins, width, recent),
                               "tree int, place int, feature int, bin int, g long, h long")
        found = best_splits(hist, [specs[s].params for s, *_ in owners], int(rows // HIST_ROWS) + 1)
        by_node = {(r["tree"], r["place"]): r for r in found.collect()}  # a row an open node
        for i, (s, tree, open_, nodes) in enumerate(owners):
            p = specs[s].params
            open_.clear()
            for j, node in enumerate(nodes):
                r = by_node.get((i, j))
                if r is None:  # no row was drawn
                    continue
                if node == 0:
                    tree.value[0] = leaf(r["all_g"], r["all_h"], p)
                b = r["best"]
                if b["gain"] <= LEAST_GAIN or b["gain"] < p.gamma:
                    continue
                values = leaf(b["g"], b["h"], p), leaf(r["all_g"] - b["g"], r["all_h"] - b["h"], p)
                for child in tree.split(node, -b["nf"], -b["nb"], b["gain"], values):
                    open_[child] = None
    for s, c, tree, _ in trees:
        specs[s].trees.append((rnd, c, tree))


def boost(data: DataFrame, n_classes: int, n_features: int, params: Sequence[BoostParams], seed: int = 1,
          n_bins: int = MAX_BINS, stage_every: int = STAGE) -> list[list[tuple[int, int, Tree]]]:
    """Trees (round, class, tree) of every parameter set, grown together over the
    rows of :func:`binned`."""
    spark, width = data.sparkSession, len(params) * n_classes
    specs = [Spec(p, seed, i * n_classes, []) for i, p in enumerate(params)]
    path = scratch_path(spark, "boost")
    pack(data, n_features, width).write.parquet(path)
    now, recent = spark.read.schema(PACKED).parquet(path).persist(), []
    try:
        for rnd in range(max(p.n_estimators for p in params)):
            live = [i for i, s in enumerate(specs) if rnd < s.params.n_estimators]
            grow_round(now, specs, live, rnd, n_classes, n_features, n_bins, width, recent)
            recent = recent + [(specs[i].first + c, t.arrays()) for i in live for r, c, t in specs[i].trees[-n_classes:]]
            if (rnd + 1) % stage_every == 0 and rnd + 1 < max(p.n_estimators for p in params):
                new = scratch_path(spark, "boost")
                with_margins(now, n_features, width, recent).write.parquet(new)
                now.unpersist()
                drop_folder(spark, path)
                path, recent = new, []
                now = spark.read.schema(PACKED).parquet(path).persist()
    finally:
        now.unpersist()
        drop_folder(spark, path)
    return [s.trees for s in specs]


def with_margins(data: DataFrame, n_features: int, width: int, recent) -> DataFrame:
    """The chunks with their margins after the trees ``recent``."""
    def run(batches):
        for b in batches:
            now = [with_trees(m, bins, recent).tobytes() for bins, *_, m in chunks(b, n_features, width)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(now, pa.binary())], b.schema.names)

    return data.mapInArrow(run, PACKED)


# ------------------------------------------------------------ Spark ML classes
class HistBoostModel(Model, HasFeaturesCol, HasLabelCol, MLReadable, MLWritable):
    """Fitted trees. ``nodes()`` is their table; ``transform`` adds ``rawPrediction`` (margins), ``probability`` and
    ``prediction``, row by row in Arrow batches."""

    numClasses = Param(Params._dummy(), "numClasses", "number of classes", TypeConverters.toInt)
    numFeatures = Param(Params._dummy(), "numFeatures", "number of features", TypeConverters.toInt)

    def __init__(self, trees=(), cuts=(), n_classes: int = 0):
        super().__init__()
        self.trees, self.cuts = list(trees), [np.asarray(c, float) for c in cuts]
        self._set(numClasses=n_classes, numFeatures=len(self.cuts), featuresCol="features", labelCol="label")

    @property
    def n_classes(self) -> int:
        return self.getOrDefault(self.numClasses)

    @property
    def featureImportances(self):
        """Gain by feature, summing to one."""
        from pyspark.ml.linalg import Vectors
        total = np.zeros(len(self.cuts))
        for _, _, t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return Vectors.dense(total / (total.sum() or 1.0))

    def node_rows(self) -> list[tuple]:
        """(round, class, node, feature, threshold, left, right, value, gain): rows below the threshold go left."""
        out = []
        for rnd, c, t in self.trees:
            for i, (f, cut, left, v, g) in enumerate(zip(t.feature, t.cut, t.left, t.value, t.gain, strict=True)):
                split = f >= 0
                out.append((rnd, c, i, f, float(self.cuts[f][cut]) if split else None, left if split else None,
                            left + 1 if split else None, float(v), float(g)))
        return out

    def nodes(self, spark) -> DataFrame:
        return spark.createDataFrame(self.node_rows(), "round int, class int, node int, feature int, threshold double, "
                                     "left int, right int, value double, gain double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, n = self.cuts, self.n_classes
        trees = [(c, t.arrays()) for _, c, t in self.trees]

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            bins = to_bins(np.stack(x.to_list()), cuts)
            order, starts = distinct(bins)  # rows of the same bins have the same margins
            found = with_trees(np.zeros((len(starts), n)), bins[order[starts]], trees)
            out = np.empty((len(bins), n))
            out[order] = np.repeat(found, np.diff(starts, append=len(bins)), axis=0)
            return pd.Series(list(out))

        raw = F.col("__margins")
        top = F.array_max(raw)
        e = F.transform(raw, lambda m: F.exp(m - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
        d = dataset.withColumn("__margins", margins(vector_to_array(self.getFeaturesCol())))
        return d.withColumns({"rawPrediction": array_to_vector(raw),
                              "probability": array_to_vector(F.transform(e, lambda v: v / total)),
                              "prediction": (F.array_position(raw, top) - 1).cast("double")}).drop("__margins")

    def evaluate_each_round(self, sets: DataFrame, set_col: str = "set") -> DataFrame:
        """``<set>, n_trees, loss``: the mean log-loss of each set after each round. One pass: a row's margins
        are carried from round to round, and a task emits one sum per set and round."""
        cuts, n, label = self.cuts, self.n_classes, self.getLabelCol()
        rounds: list[list] = [[] for _ in range(1 + max((r for r, _, _ in self.trees), default=-1))]
        for r, c, t in self.trees:
            rounds[r].append((c, t.arrays()))
        d = sets.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(label).cast("int").alias("y"),
                        F.col(set_col).cast("string").alias("s"))

        def run(batches):
            sums: dict = {}
            for b in batches:
                bins, y = to_bins(matrix(b.column(0), len(cuts)), cuts), b.column(1).to_numpy()
                names, code = np.unique(np.array(b.column(2).to_pylist(), dtype=object).astype(str), return_inverse=True)
                m = np.zeros((len(bins), n))
                for r, trees in enumerate(rounds):
                    m = with_trees(m, bins, trees)
                    loss = -np.log(np.maximum(soft_max(m)[np.arange(len(y)), y], LOSS_EPS))
                    for s, v, k in zip(names, np.bincount(code, loss), np.bincount(code), strict=True):
                        old = sums.get((s, r), (0.0, 0))
                        sums[s, r] = old[0] + v, old[1] + k
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(s) for s, _ in sums]), pa.array([r + 1 for _, r in sums], pa.int32()),
                     pa.array([v for v, _ in sums.values()], pa.float64()), pa.array([int(k) for _, k in sums.values()], pa.int64())],
                    ["s", "n_trees", "loss", "n"])

        per = d.mapInArrow(run, "s string, n_trees int, loss double, n long")
        return per.groupBy(F.col("s").alias(set_col), "n_trees").agg((F.sum("loss") / F.sum("n")).alias("loss"))

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        m, spark = self.instance, self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark)
        rows = [(r, c, i, int(f), int(cut), int(left), float(v), float(g)) for r, c, t in m.trees
                for i, (f, cut, left, v, g) in enumerate(zip(t.feature, t.cut, t.left, t.value, t.gain, strict=True))]
        spark.createDataFrame(rows, "round int, class int, node int, feature int, cut int, left int, value double, "
                              "gain double").write.parquet(f"{path}/nodes")
        spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(m.cuts)],
                              "feature int, cuts array<double>").write.parquet(f"{path}/cuts")


class _ModelReader(MLReader):
    def load(self, path):
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        cuts = {r["feature"]: r["cuts"] for r in spark.read.parquet(f"{path}/cuts").collect()}
        trees: dict[tuple[int, int], Tree] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "class", "node").collect():  # the model itself
            t = trees.get((r["round"], r["class"]))
            if t is None:
                t = trees[r["round"], r["class"]] = Tree()
                t.feature, t.cut, t.left, t.value, t.gain = [], [], [], [], []
            for name in ("feature", "cut", "left", "value", "gain"):
                getattr(t, name).append(r[name])
        m = HistBoostModel([(*k, t) for k, t in trees.items()], [cuts[i] for i in range(len(cuts))])
        m._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(m, meta)
        return m


class HistBoostClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, DefaultParamsReadable,
                          DefaultParamsWritable):
    """Estimator over a vector column and labels 0..n-1; ``params`` is the JSON of the search space's names."""

    boostParams = Param(Params._dummy(), "boostParams", "parameters as JSON", TypeConverters.toString)
    numClasses = Param(Params._dummy(), "numClasses", "number of classes (0: from the labels)", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "column whose hash draws the rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, boostParams="{}", numClasses=0,
                 seed=1, maxBins=MAX_BINS, idCol=""):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(featuresCol="features", labelCol="label", boostParams="{}", numClasses=0, seed=1,
                         maxBins=MAX_BINS, idCol="")

    def _fit(self, dataset: DataFrame) -> HistBoostModel:
        import json
        return self.fit_many(dataset, [json.loads(self.getOrDefault(self.boostParams))])[0]

    def fit_many(self, dataset: DataFrame, params: Sequence[dict]) -> list[HistBoostModel]:
        """A model for each parameter set, boosted together over the same rows."""
        some = [BoostParams.of(p) for p in params]
        feats, label = self.getFeaturesCol(), self.getLabelCol()
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        x = vector_to_array(feats)
        head = dataset.select(F.size(x).alias("w")).first()
        if head is None:
            raise ValueError("no rows to fit")
        n_features = head["w"]
        d = dataset.withColumn("__x", x)
        cuts = feature_cuts(d.select(*[F.col("__x")[i].alias(f"f{i}") for i in range(n_features)]),
                            [f"f{i}" for i in range(n_features)], self.getOrDefault(self.maxBins))
        n = self.getOrDefault(self.numClasses) or int(dataset.agg(F.max(label)).first()[0]) + 1
        id_col = self.getOrDefault(self.idCol) or None
        rows = binned(d, cuts, "__x", label, weight, id_col)
        found = boost(rows, n, n_features, some, self.getOrDefault(self.seed),
                      max(len(c) for c in cuts) + 1)
        return [HistBoostModel(t, cuts, n)._set(featuresCol=feats, labelCol=label) for t in found]
