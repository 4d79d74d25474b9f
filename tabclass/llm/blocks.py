"""Documents in compressed blocks, so that corpus-wide tables (n-gram scores,
word counts) meet them by a join on the block instead of one row per token.

One pass over the documents writes a table bucketed by block: blobs of about a
megabyte of rows (zstd Arrow streams), and for each block, a run of about
``BLOCK`` bytes of text inside a task, its distinct items. The items are far
fewer than the tokens; only they are shuffled, joined, and brought back to
their block. The table's buckets are already where that last join needs them,
so the documents themselves are never shuffled, and a lost executor or another
number of executors changes nothing: blocks are fixed once written.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import text_bytes

BLOB = 1 << 20
BLOCK = 32 << 20
BUCKETS = 1 << 16  # at most (Spark refuses 100,000); a bucket then holds several blocks, read one by one


def to_blob(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(out, batch.schema, options=options) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def from_blob(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as r:
        return r.read_next_batch()


def cut(batch: pa.RecordBatch, text: int, size: int = BLOB):
    """Runs of rows with about ``size`` bytes of text; no row is divided."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def write_blocks(docs: DataFrame, text_col: str, collect, item_type: str, name: str) -> str:
    """Writes the table ``block, blob, items`` and tells its name; whoever asked
    for it drops it when the results are written. ``collect()`` makes an object that is
    given each batch of a block (``add``) and tells its distinct items (``get``,
    a pyarrow array of ``item_type``); they are the items of the block's last
    row. All columns of ``docs`` are in the blobs."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    n = text_bytes(docs, text_col) // BLOCK + 1
    schema = StructType.fromDDL(f"block bigint, blob binary, items array<{item_type}>")
    item = to_arrow_schema(schema).field("items").type

    def run(batches):
        held, blobs, seen, closed = 0, [], collect(), 0

        def close():
            nonlocal closed
            block, closed = TaskContext.get().partitionId() << 32 | closed, closed + 1
            lists = pa.concat_arrays([pa.nulls(len(blobs) - 1, item), one_list(seen.get(), item)])
            return pa.RecordBatch.from_arrays(
                [pa.array([block] * len(blobs), pa.int64()), pa.array(blobs, pa.binary()), lists],
                ["block", "blob", "items"])

        for b in batches:
            for part in cut(b, at):
                blobs.append(to_blob(part))
                seen.add(part)
                held += pc.sum(pc.binary_length(part.column(at))).as_py() or 0
                if held >= BLOCK:
                    yield close()
                    held, blobs, seen = 0, [], collect()
        if blobs:
            yield close()

    table = f"{name}_{uuid.uuid4().hex}"
    (docs.mapInArrow(run, schema).write.format("parquet").option("compression", "zstd")
     .bucketBy(min(3 * n, BUCKETS), "block").saveAsTable(table))  # three buckets a block: hardly two blocks in one
    return table


def one_list(items: pa.Array, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items.cast(kind.value_type))
