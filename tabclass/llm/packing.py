"""Packing along a space-filling curve.

Documents are tokenized, their hashed token vectors projected to a few
dimensions, and ordered by the Hilbert key of their cell, so that alike
documents lie near each other on the curve. A range sort by (key, id) deals the
curve out, and every part is packed into sequences without a gap: documents are
cut where a sequence is full, and what is left at a part's end is cut into
sequences of power-of-two lengths. So no sequence needs padding.

The tokenized documents are written to the shared folder once; the range
bounds, the coordinates' means and deviations, and the packing all read that
table. Equal documents have equal keys and are told apart by id, so that a
group of copies spreads over as many parts as its size asks for.

Ids are those that the tokenizer itself gives: the string of a special token in
a text is that token.

Defined results: a null or empty text is its end id alone; documents with a
null id come first among equal keys; repeated rows are packed once each; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import parts_for, staged

LENGTH = 1024
END_ID = 0
HASHED = 256       # dimensions of the hashed vectors
DIMS, BITS = 4, 10  # of the curve
PART_BYTES = 64 << 20
KNOWN = 150_000    # words whose ids a worker remembers, in each of two generations


# -------------------------------------------------------------- tokenizing
#: white space other than the plain space and the line feed
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　\x00]")
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")


def segments(text: str) -> list[str]:
    """``text`` cut where byte-level BPE always cuts: before a single space
    between two words, and around a single line feed between two words. The ids
    of the segments, joined, are those of the text."""
    if (ODD_SPACE.search(text) or "  " in text or "\n\n" in text or " \n" in text or "\n " in text):
        return SAFE_CUT.split(text)
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as this Python worker."""
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def byte_alphabet() -> dict[int, str]:
    """The character by which byte-level BPE writes each byte: printable ones as
    themselves, the others as U+0100 onwards in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Known(dict):
    """Ids by segment, as little-endian unsigned 16-bit bytes; what is missing is
    taken from the generation ``before`` or tokenized."""

    def __init__(self, tokenizer, before: dict):
        super().__init__()
        self.tokenizer, self.before = tokenizer, before
        self.merge, self.alphabet = tokenizer.model.tokenize, byte_alphabet()

    def __missing__(self, s: str) -> bytes:
        ids = dict.get(self.before, s)
        if ids is None:
            bare = s[1:] if s[:1] == " " else s
            if bare.isalpha() and max(bare) < "ɐ":  # Latin letters alone: one run of letters, merged as it is
                chars = s.encode().decode("latin-1").translate(self.alphabet)
                ids = array("H", [t.id for t in self.merge(chars)]).tobytes()
            elif len(s) > 2 and s[-1] in ",.!?" and s[-2].isalpha():
                ids = self[s[:-1]] + self[s[-1]]  # "word," is its word and its comma
            else:
                ids = np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, dtype="<u2").tobytes()
        self[s] = ids
        return ids


class Encoder:
    """Ids of whole texts; the worker remembers those of segments, in two
    generations, so that what is still in use stays."""

    def __init__(self, json: str, remember: int = KNOWN):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.remember = remember
        self.held = worker_cache(f"tabclass_ids_{zlib.crc32(json.encode())}")
        if "known" not in self.held:
            tokenizer = Tokenizer.from_str(json)
            self.held["known"] = Known(tokenizer, {})
            special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            # longer ones first; without any, what never matches
            self.held["special"] = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.held["known"]
        if len(known) > self.remember:
            known.before = {}
            known = self.held["known"] = Known(known.tokenizer, known)
        ids, special = known.__getitem__, self.held["special"]
        out = []
        for t in texts:
            if special.search(t):  # the text between special tokens is tokenized by itself
                cuts = [0, *(x for m in special.finditer(t) for x in m.span()), len(t)]
                parts = [t[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                out.append(b"".join(ids(p) if k % 2 else b"".join(map(ids, segments(p))) for k, p in enumerate(parts)))
            else:
                out.append(b"".join(map(ids, segments(t))))
        return out


# ------------------------------------------------------------ vectors, curve
def projection() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket and sign of each id, random projection); fixed by their seed."""
    r = np.random.default_rng(2)
    return (r.integers(0, HASHED, 65536), r.choice([-1.0, 1.0], 65536), r.standard_normal((HASHED, DIMS)))


def coordinates(ids: np.ndarray, bucket, sign, matrix) -> np.ndarray:
    v = np.bincount(bucket[ids], weights=sign[ids], minlength=HASHED)
    norm = np.sqrt(v @ v)
    return (v / norm if norm else v) @ matrix


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows of ``cells``): Gray
    decoding of the axes from the highest bit down, then interleaved bits."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[-1] >> b) & 1 != 0, (1 << b) - 1, 0)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenized(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, remember: int) -> DataFrame:
    """``doc_id, ids`` (with the end id) and the projected coordinates."""
    json = open(tokenizer, encoding="utf-8").read()  # on the driver; tasks get its text
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([END_ID], dtype="<u2").tobytes()

    def run(batches):
        encode, (bucket, sign, matrix) = Encoder(json, remember), projection()
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = [x + end for x in encode([t or "" for t in part.column(1).to_pylist()])]
                at = np.array([coordinates(np.frombuffer(x, dtype="<u2"), bucket, sign, matrix) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), *(pa.array(at[:, i]) for i in range(DIMS))],
                    ["doc_id", "ids", *(f"x{i}" for i in range(DIMS))])

    cols = ", ".join(f"x{i} double" for i in range(DIMS))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids binary, {cols}")


def _keyed(t: DataFrame) -> DataFrame:
    """Adds ``key``: each coordinate spread over its cells by mean and deviation."""
    stats = t.agg(*[f(f"x{i}") for i in range(DIMS) for f in (F.avg, F.stddev_pop)]).first()
    mean = [stats[2 * i] or 0.0 for i in range(DIMS)]
    dev = [stats[2 * i + 1] or 1.0 for i in range(DIMS)]

    @F.pandas_udf("long")
    def key(a, b, c, d):
        z = np.stack([(s.to_numpy() - m) / v for s, m, v in zip((a, b, c, d), mean, dev, strict=True)], axis=1)
        cells = np.clip((0.5 + 0.5 * np.tanh(0.8 * z)) * (1 << BITS), 0, (1 << BITS) - 1)
        # coordinates are rounded so that sums in another order give the same cell
        return pd.Series(hilbert_key(np.floor(np.round(cells, 6)).astype(np.int64)))

    return t.withColumn("key", key(*[F.col(f"x{i}") for i in range(DIMS)])).select("key", "doc_id", "ids")


def pack_documents(docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", length: int = LENGTH,
                   with_ids: bool = True, remember: int = KNOWN) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset`` and, if asked for, the piece's ``ids``. A
    worker remembers the ids of up to twice ``remember`` words (about 200 bytes
    each): more memory, less tokenizing."""
    t = staged(tokenized(docs, tokenizer, id_col, text_col, remember), "pack-tokens")
    size = int(t.agg(F.sum(F.length("ids"))).first()[0] or 0)
    parts = parts_for(docs.sparkSession, size, PART_BYTES)
    ordered = (_keyed(t).repartitionByRange(parts, F.col("key"), F.col("doc_id"))
               .sortWithinPartitions("key", "doc_id"))
    id_type = t.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [("doc_id", to_arrow_type(id_type)), *((n, pa.int64()) for n in names[1:])]
    ddl = f"doc_id {id_type.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:])
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        open_: list = []  # pieces of the unfinished sequence: (doc_id, start, ids, doc_tokens)
        held, rows = 0, []

        def close(pieces):
            nonlocal number
            at = 0
            for doc, start, ids, total in pieces:
                row = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, at)
                rows.append(row + (ids.astype(np.int32),) if with_ids else row)
                at += len(ids)
            number += 1

        def flush():
            cols = list(zip(*rows, strict=True))
            arrays = [pa.array(c, f.type) for c, f in zip(cols[:7], schema, strict=False)]
            if with_ids:
                ends = np.cumsum([0, *(len(x) for x in cols[7])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(cols[7]))))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for b in batches:
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(raw, dtype="<u2")
                at = 0
                while at < len(ids):
                    some = ids[at:at + length - held]
                    open_.append((doc, at, some, len(ids)))
                    at += len(some)
                    held += len(some)
                    if held == length:
                        close(open_)
                        open_, held = [], 0
                if len(rows) >= 4096:
                    yield flush()
        while held:  # the end of this part, by powers of two
            want = 1 << (held.bit_length() - 1)
            held -= want
            now, rest = [], []
            for doc, start, ids, total in open_:
                if want:
                    now.append((doc, start, ids[:want], total))
                if len(ids) > want:
                    rest.append((doc, start + want, ids[want:], total))
                want -= min(want, len(ids))
            close(now)
            open_ = rest
        if rows:
            yield flush()

    return ordered.mapInArrow(run, ddl)
