"""Exact k-nearest neighbours by cells, for vectors of few dimensions (used by :mod:`.knn`).

A tree of median cuts (per group) divides the space into cells of about ``cell_rows``
candidates. Its cuts come from a hashed share of the candidates and only balance the
cells; their number and bounding box come from all rows. A query first meets the cell it
lies in: the distance of its k-th neighbour there bounds how far the others can be.
It then meets every other cell whose box reaches into that distance, so nothing is
missed. Work grows with the queries times the few cells around each, not with queries
times candidates.

A cell with many queries is cut into blocks of queries, each with the whole cell. Of
candidates with one vector only those that can be among a query's k best (ties go to the
smallest ids) enter a cell, so a cell stays small where many rows are alike.
The driver holds the share of vectors that the cuts come from and a box per cell.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.rowwise import lookup_small
from ..session import staged
from .knn import _codes, _top

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[_top.__module__])

CELL_ROWS = 1024
CELL_SAMPLE = 16      # vectors of a cell that the cuts come from
QUERY_ROWS = 16384    # queries of a cell that one group compares
VISITS = 4096         # queries whose cells are looked up in one go


class Cells:
    """The trees of all groups in arrays: ``dim`` (-1: a cell), ``cut`` (up to it goes
    left), ``left`` (the right child follows it); ``root`` of each group; boxes."""

    def __init__(self, width: int):
        self.width, self.dim, self.cut, self.left, self.root = width, [], [], [], {}

    def _node(self) -> int:
        for a, v in ((self.dim, -1), (self.cut, 0.0), (self.left, 0)):
            a.append(v)
        return len(self.dim) - 1

    def grow(self, group, x: np.ndarray, most: int) -> None:
        """A tree over the vectors ``x``, cut until at most ``most`` of them are in a cell."""
        self.root[group] = self._node()
        todo = [(self.root[group], x)]
        while todo:
            node, x = todo.pop()
            if len(x) <= most:
                continue
            for d in np.argsort(-np.ptp(x, axis=0)):  # the widest dimension that can be cut
                at = np.median(x[:, d])
                at = at if (x[:, d] > at).any() else x[x[:, d] < at, d].max(initial=-np.inf)
                if np.isfinite(at):
                    break
            else:
                continue  # all alike
            lo = x[:, d] <= at
            a, b = self._node(), self._node()
            self.dim[node], self.cut[node], self.left[node] = int(d), float(at), a
            todo += [(a, x[lo]), (b, x[~lo])]

    def close(self, boxes: dict[int, tuple]) -> None:
        """Boxes of the cells with rows, ``cell -> (lows, highs)``; those of inner nodes follow."""
        self.dim, self.cut, self.left = np.array(self.dim, int), np.array(self.cut, float), np.array(self.left, int)
        self.lo = np.full((len(self.dim), self.width), np.inf)
        self.hi = -self.lo
        for cell, (lo, hi) in boxes.items():
            self.lo[cell], self.hi[cell] = lo, hi
        for n in range(len(self.dim) - 1, -1, -1):  # children come after their parent
            if self.dim[n] >= 0:
                a = self.left[n]
                self.lo[n], self.hi[n] = np.minimum(self.lo[a], self.lo[a + 1]), np.maximum(self.hi[a], self.hi[a + 1])

    def route(self, x: np.ndarray, root: np.ndarray) -> np.ndarray:
        """The cell each row lies in."""
        dim, cut, left = np.asarray(self.dim), np.asarray(self.cut), np.asarray(self.left)
        node, rows = root.copy(), np.arange(len(x))
        while True:
            d = dim[node[rows]]
            rows, d = rows[d >= 0], d[d >= 0]
            if not len(rows):
                return node
            at = node[rows]
            node[rows] = left[at] + (x[rows, d] > cut[at])

    def within(self, x: np.ndarray, root: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells with rows whose box is at most ``r`` away."""
        limit = r * r * (1 + 1e-9) + 1e-300
        row, node, found = np.arange(len(x)), root, []
        while len(row):
            d = np.maximum(np.maximum(self.lo[node] - x[row], x[row] - self.hi[node]), 0.0)
            near = (np.einsum("ij,ij->i", d, d) <= limit[row]) & (self.lo[node, 0] <= self.hi[node, 0])
            row, node = row[near], node[near]
            cell = self.dim[node] < 0
            found.append((row[cell], node[cell]))
            row, a = row[~cell], self.left[node[~cell]]
            row, node = np.concatenate([row, row]), np.concatenate([a, a + 1])
        return tuple(np.concatenate(v) for v in zip(*found)) if found else (row, node)


def vectors(column, width: int) -> np.ndarray:
    values = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _ids(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object) if column.null_count else column.to_numpy()


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _at_root(batch, part: list[str], root: dict):
    """The batch's rows whose group has a tree, and their roots."""
    groups = zip(*(batch.column(p).to_pylist() for p in part)) if part else [()] * batch.num_rows
    at = np.array([root.get(g, -1) for g in groups], dtype=int)
    return batch.filter(pa.array(at >= 0)), at[at >= 0]


def _thinned(c: DataFrame, part: list[str], k: int, exclude_self: bool) -> DataFrame:
    """Of candidates with one vector those that can be among a query's ``k`` best: the
    smallest ids, and as many again where a query leaves out its own id."""
    def first(df, by, n, order):
        w = Window.partitionBy(*by).orderBy(order)
        return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")

    if exclude_self:
        c = first(c, [*part, "cf", "cid"], k, "cid")
    return first(c, [*part, "cf"], 2 * k if exclude_self else k, "cid")


def _blocks_of(queries: DataFrame, candidates: DataFrame, query_rows: int):
    """Both with ``cell`` and ``block``: a cell's queries in blocks, its candidates in each of them."""
    n = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    n = staged(n.select("cell", F.ceil(F.col("n") / query_rows).cast("int").alias("__b")), "knn-blocks")
    q = lookup_small(queries, n, "cell", ["__b"]).withColumn("block", (F.col("qn") % F.col("__b")).cast("int")).drop("__b")
    c = candidates.join(n, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("__b") - 1))).drop("__b")
    return q.groupBy("cell", "block"), c.groupBy("cell", "block")


def knn_by_cells(q: DataFrame, c: DataFrame, k: int, width: int, part: Sequence[str], exclude_self: bool,
                 carry: Sequence[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Neighbours of ``part..., qid, qf`` among ``part..., cid, cf, __c_<carry>``, all vectors finite:
    ``part..., qid, cid, dist, carry...``, the ``k`` nearest of each query row at least."""
    part = list(part)
    c = staged(_thinned(c, part, k, exclude_self), "knn-candidates")
    share = max(1, cell_rows // CELL_SAMPLE)
    some = c.where(F.pmod(F.xxhash64("cf", "cid"), F.lit(share)) == 0).select(*part, "cf").collect()
    by_group: dict = {tuple(r): [] for r in c.select(*part).distinct().collect()} if part else {(): []}
    for r in some:
        by_group[tuple(r[:-1])].append(r["cf"])
    cells = Cells(width)
    for g, x in by_group.items():
        cells.grow(g, np.array(x, float).reshape(-1, width), max(1, cell_rows // share))

    def with_cell(df: DataFrame, vec: str) -> DataFrame:
        def run(batches):
            for b in batches:
                b, root = _at_root(b, part, cells.root)
                cell = cells.route(vectors(b.column(vec), width), root)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*b.schema.names, "cell"])

        return df.mapInArrow(run, f"{_ddl(df)}, cell long")

    c = staged(with_cell(c, "cf"), "knn-cells")
    sides = [F.struct(*[f(F.col("cf")[i]).alias(f"d{i}") for i in range(width)]).alias(n)
             for n, f in (("lo", F.min), ("hi", F.max))]
    boxes = {r["cell"]: (tuple(r["lo"]), tuple(r["hi"])) for r in c.groupBy("cell").agg(*sides).collect()}  # a row a cell
    here = staged(with_cell(q.withColumn("qn", F.monotonically_increasing_id()), "qf"), "knn-home")
    cells.close(boxes)
    got = ["cid", "dist", *carry]
    kinds = {f.name: f.dataType.simpleString() for f in (*q.schema.fields, *c.schema.fields)} | {"dist": "double"}
    got_ddl = [f"`{x}` {kinds['__c_' + x] if x in carry else kinds[x]}" for x in got]
    q_ddl = ", ".join(f"`{n}` {kinds[n]}" for n in (*part, "qid", "qf")) + ", qn long"
    near_ddl = f"{q_ddl}, cell long, near array<struct<{', '.join(x.replace('` ', '`: ', 1) for x in got_ddl)}>>"
    near_schema = to_arrow_schema(StructType.fromDDL(near_ddl))
    flat_ddl = ", ".join([*(f"`{n}` {kinds[n]}" for n in (*part, "qid")), *got_ddl])
    flat_schema = to_arrow_schema(StructType.fromDDL(flat_ddl))

    def best(some: pa.Table, others: pa.Table):
        qcode, ccode = _codes(_ids(some.column("qid")), _ids(others.column("cid")))
        qi, ci, dist = _top(vectors(some.column("qf"), width), vectors(others.column("cf"), width), qcode, ccode, k, exclude_self)
        found = others.take(pa.array(ci))
        return qi, dist, [found.column("cid"), pa.chunked_array([pa.array(dist)]), *(found.column(f"__c_{x}") for x in carry)]

    def at_home(some: pa.Table, others: pa.Table) -> pa.Table:
        if not some.num_rows:
            return near_schema.empty_table()
        qi, _, columns = best(some, others)
        item = near_schema.field("near").type.value_type
        rows = pa.StructArray.from_arrays([x.combine_chunks().cast(item.field(i).type) for i, x in enumerate(columns)],
                                          fields=[item.field(i) for i in range(item.num_fields)])
        ends = np.searchsorted(qi, np.arange(some.num_rows + 1)).astype(np.int32)
        near = pa.ListArray.from_arrays(pa.array(ends), rows)
        return pa.Table.from_arrays([*(some.column(n) for n in near_schema.names[:-1]), near], near_schema.names).cast(near_schema)

    def elsewhere(some: pa.Table, others: pa.Table) -> pa.Table:
        if not some.num_rows or not others.num_rows:
            return flat_schema.empty_table()
        qi, dist, columns = best(some, others)
        keep = pa.array(dist <= some.column("r").to_numpy()[qi])
        t = pa.Table.from_arrays([*(some.column(n).take(pa.array(qi)) for n in (*part, "qid")), *columns], flat_schema.names)
        return t.filter(keep).cast(flat_schema)

    def visits(batches):
        names = [*part, "qid", "qf", "qn", "r"]
        for b in batches:
            for s in range(0, b.num_rows, VISITS):
                t, root = _at_root(b.slice(s, VISITS), part, cells.root)
                row, cell = cells.within(vectors(t.column("qf"), width), root, t.column("r").to_numpy())
                other = cell != t.column("cell").to_numpy()[row]
                rows = pa.array(row[other])
                yield pa.RecordBatch.from_arrays([*(t.column(n).take(rows) for n in names), pa.array(cell[other])], [*names, "cell"])

    left, right = _blocks_of(here, c, QUERY_ROWS)
    home = staged(left.cogroup(right).applyInArrow(at_home, near_ddl), "knn-near")
    r = F.coalesce(F.get("near", F.lit(k - 1))["dist"], F.lit(float("inf")))
    away = staged(home.withColumn("r", r).drop("near").mapInArrow(visits, f"{q_ddl}, r double, cell long"), "knn-visits")
    left, right = _blocks_of(away, c, QUERY_ROWS)
    return home.select(*part, "qid", F.inline("near")).unionByName(left.cogroup(right).applyInArrow(elsewhere, flat_ddl))
