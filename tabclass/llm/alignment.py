"""Cross-tokenizer alignment by white-space token anchors.

Every text is tokenized whole by both tokenizers, A byte-level and B by pieces, and both
token sequences are spelt out: where the bytes are not those of a space and the
text, the document has no tokens. Byte offsets where tokens of both end cut the
tokens into groups. A shared end before a space-marked token (one that begins with the
space) is an anchor; anchors cut a document into short windows of token ids, hardly
more than a word each. A window's groups and linked id pairs follow from its ids alone, so a
worker remembers them by the tuple of ids; a window seen before costs one look-up.

An id pair's count is the number of documents that hold it linked. Documents are read
once, in blocks of about ``BLOCK`` bytes of text: a block is written with each document's pairs
(by number) and the block's distinct pairs with their document counts, which are
summed over the blocks and joined back to them. So what is shuffled grows with the
distinct pairs of blocks, not with tokens, and a pair that all documents hold is one
row a block. Blocks meet their counts by an ordinary co-group on the block.

Defined results: a null or empty text has no tokens, as has one that a tokenizer does not
give back byte by byte; then all numbers are 0 and the digest is ''. Strings of special
tokens are ordinary text. Every row is a document of its own, repeated rows and null
ids too; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .blocks import cut, from_blob, to_blob
from .common import staged
from .packing import byte_alphabet, worker_cache

BLOCK = 32 << 20     # bytes of text of a block
STEP = 1 << 19       # bytes of text aligned at once
WINDOWS = 200_000    # windows a worker remembers, at most, between two steps
#: beyond these characters the two libraries' Unicode tables need not be the same
OTHER = re.compile("[^\x00-ɏ–-”…]")
LONG_SPACE = re.compile(r"\s{50000}")
#: fixed value: how byte-level BPE of this kind cuts a text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Side:
    """One tokenizer's tokens: their bytes, lengths, and whether they begin with a space."""

    def __init__(self, spelt: list[bytes]):
        self.spelt = spelt
        self.length = np.array([len(x) for x in spelt], np.int64)
        self.spaced = np.array([x[:1] == b" " for x in spelt])

    def spells(self, ids: list[int], text: bytes) -> bool:
        return b"".join(map(self.spelt.__getitem__, ids)) == text


class ByteLevel(Side):
    """Byte-level BPE from its JSON file. Latin text goes through the faster of two
    libraries, when the file's merges are numbered in their order; both give the same ids."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        model = json.loads(text)["model"]
        byte_of = {c: b for b, c in byte_alphabet().items()}
        spelt = [b""] * len(model["vocab"])
        for token, i in model["vocab"].items():
            spelt[i] = (bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token)
                        else token.encode())
        self.slow = Tokenizer.from_str(text)
        self.slow.encode_special_tokens = True  # their strings in a text are ordinary text
        for i in range(len(spelt), self.slow.get_vocab_size()):
            spelt.append((self.slow.id_to_token(i) or "").encode())
        super().__init__(spelt)
        joined = [x if isinstance(x, str) else "".join(x) for x in model["merges"]]
        at = [model["vocab"][x.replace(" ", "")] for x in joined]
        self.fast = None
        if at == sorted(at) and at and len(at) + 256 == at[-1] + 1:
            ranks = {spelt[i]: i for i in range(at[-1] + 1)}
            self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for t in texts:
            if self.fast is None or OTHER.search(t) or len(t) > 50_000 and LONG_SPACE.search(t):
                out.append(self.slow.encode(t, add_special_tokens=False).ids)
            else:
                out.append(self.fast.encode_ordinary(t))
        return out


class Pieces(Side):
    """A piece model from its file's bytes; it puts a space before the text itself."""

    def __init__(self, proto: bytes):
        import sentencepiece

        m = self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        super().__init__([bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i)
                          else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32, sum(map(len, lists)))


class Runs:
    """Lists of numbers, one after the other."""

    def __init__(self):
        self.first, self.items = array("q", [0]), array("q")

    def add(self, items):
        self.items.extend(items)
        self.first.append(len(self.items))

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``items`` of the lists ``which``, and the length of each list."""
        first = np.array(self.first)
        n = first[which + 1] - first[which]
        return np.arange(n.sum()) + np.repeat(first[which] - np.cumsum(n) + n, n), n


class Aligner:
    """Windows that were aligned before, by their ids, as lists of groups; and the groups'
    linked pairs, both by number."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.long_a, self.long_b = a.length.tolist(), b.length.tolist()
        self.clear()

    def clear(self):
        self.number: dict[bytes, int] = {}   # a window's ids -> its number
        self.text: list[bytes] = []          # its groups as text
        self.groups = Runs()                 # its groups
        self.group_no: dict[int | tuple, int] = {}  # a group's A ids, -1, B ids (or one pair of ids) -> its number
        self.group_text: list[str] = []
        self.pairs, self.times = Runs(), array("q")  # a group's distinct pairs, and how often each is linked
        self.pair_no: dict[int, int] = {}
        self.codes = array("q")

    def group(self, key, a: list[int], b: list[int]) -> int:
        pairs, of_b = [], Counter(b).items()
        for x, n in Counter(a).items():
            for y, m in of_b:
                code = x << 32 | y
                no = self.pair_no.setdefault(code, len(self.codes))
                if no == len(self.codes):
                    self.codes.append(code)
                pairs.append(no)
                self.times.append(n * m)
        self.pairs.add(pairs)
        self.group_text.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
        no = self.group_no[key] = len(self.group_text) - 1
        return no

    def learn(self, key: bytes) -> int:
        """Aligns a new window: both sides spell the same bytes, and a group ends
        where tokens of both end."""
        ids = array("i", key).tolist()
        long_a, long_b, known = self.long_a, self.long_b, self.group_no.get
        i, end = 0, ids.index(-1)
        j, groups = end + 1, []
        while i < end:
            i0, j0, a, b = i, j, ids[i], ids[j]
            x = long_a[a] - long_b[b]
            i, j = i + 1, j + 1
            if x:
                while x:
                    if x < 0:
                        x += long_a[ids[i]]
                        i += 1
                    else:
                        x -= long_b[ids[j]]
                        j += 1
                some: int | tuple = (*ids[i0:i], -1, *ids[j0:j])
            else:
                some = a << 32 | b
            no = known(some)
            groups.append(self.group(some, ids[i0:i], ids[j0:j]) if no is None else no)
        w = self.number[key] = len(self.text)
        self.groups.add(groups)
        self.text.append(";".join(map(self.group_text.__getitem__, groups)).encode())
        return w

    def windows(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> tuple[list[int], np.ndarray]:
        """Window numbers of verified documents one after the other, and each document's number of windows."""
        a, b = flat(ids_a), flat(ids_b)
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        last_a = np.cumsum([len(x) for x in ids_a]) - 1
        here = np.zeros((3, int(end_a[-1]) + 1), bool)  # by byte offset: B ends, A ends, anchors
        here[0, end_b] = here[1, end_a] = True
        stop = np.append(self.a.spaced[a[1:]], True)  # before a space-marked token
        stop[last_a] = True
        stop &= here[0, end_a]
        here[2, end_a[stop]] = True
        to_a, to_b = np.flatnonzero(stop) + 1, np.flatnonzero(here[2, end_b]) + 1
        n = len(to_a)
        from_a, from_b, k = np.append(0, to_a[:-1]), np.append(0, to_b[:-1]), np.arange(n)
        # each window's A ids, -1, its B ids
        buf = np.full(len(a) + len(b) + n, -1, np.int32)
        buf[np.arange(len(a)) + np.repeat(from_b + k, to_a - from_a)] = a
        buf[np.arange(len(b)) + np.repeat(to_a + k + 1, to_b - from_b)] = b
        raw, cuts = buf.tobytes(), (np.append(0, to_a + to_b + k + 1) * 4).tolist()
        known, learn = self.number.get, self.learn
        out = []
        for s, e in zip(cuts, cuts[1:]):
            key = raw[s:e]
            w = known(key)
            out.append(learn(key) if w is None else w)
        return out, np.diff(np.append(0, np.searchsorted(to_a, last_a + 1, "left") + 1))

    def documents(self, texts: list[str]):
        """For each text (n_a, n_b, n_groups, n_links, groups or None); then document, pair number
        and times of its distinct pairs."""
        ids_a = self.a.encode([" " + t for t in texts])
        ids_b = self.b.encode(texts)
        spelt = [(" " + t).encode() for t in texts]
        good = [i for i, t in enumerate(spelt) if len(t) > 1 and self.a.spells(ids_a[i], t) and self.b.spells(ids_b[i], t)]
        rows: list[tuple] = [(0, 0, 0, 0, None)] * len(texts)
        if not good:
            none = np.zeros(0, np.int64)
            return rows, none, none, none
        w, per_doc = self.windows([ids_a[i] for i in good], [ids_b[i] for i in good])
        w_no, ends = np.array(w), np.cumsum(per_doc)
        at, n_groups = self.groups.of(w_no)
        group_at, n_pairs = self.pairs.of(np.array(self.groups.items)[at])
        pairs, times = np.array(self.pairs.items)[group_at], np.array(self.times)[group_at]
        doc = np.repeat(np.repeat(np.repeat(np.array(good), per_doc), n_groups), n_pairs)
        key, inverse = np.unique(doc * len(self.codes) + pairs, return_inverse=True)
        linked = np.bincount(inverse, weights=times).astype(np.int64)
        doc, pair = key // len(self.codes), key % len(self.codes)
        n_links = np.bincount(doc, weights=linked, minlength=len(texts)).astype(np.int64)
        for i, s, e in zip(good, ends - per_doc, ends, strict=True):
            text = b";".join([self.text[x] for x in w[s:e]])
            rows[i] = (len(ids_a[i]), len(ids_b[i]), int(n_groups[s:e].sum()), int(n_links[i]), text)
        return rows, doc, pair, linked


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_DDL = "block long, docs binary, entries binary, pairs array<long>, held array<int>"


class Block:
    """What a block gathers until it is written: batches of documents, their pairs,
    and in how many documents each pair is."""

    def __init__(self):
        self.parts, self.size, self.held = [], 0, np.zeros(0, np.int64)

    def add(self, docs: pa.RecordBatch, doc, pair, linked, size: int, n_pairs: int):
        self.parts.append((docs, doc, pair, linked))
        self.size += size
        held = np.bincount(pair, minlength=n_pairs)
        held[:len(self.held)] += self.held
        self.held = held

    def rows(self, block: int, codes: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(self.held)
        used = used[np.argsort(codes[used])]
        place = np.zeros(len(self.held), np.int64)
        place[used] = np.arange(len(used))
        docs, entries = [], []
        for d, doc, pair, linked in self.parts:
            key = doc * len(used) + place[pair]  # sorted and as differences: small numbers
            order = np.argsort(key)
            docs.append(to_blob(d))
            entries.append(to_blob(pa.RecordBatch.from_arrays(
                [pa.array(np.diff(key[order], prepend=0)), pa.array(linked[order])], ["step", "linked"])))
        none = [None] * (len(docs) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(docs)), pa.array(docs, pa.binary()), pa.array(entries, pa.binary()),
             pa.array([*none, codes[used]], pa.list_(pa.int64())),
             pa.array([*none, self.held[used]], pa.list_(pa.int32()))], ["block", "docs", "entries", "pairs", "held"])


def aligned_blocks(docs: DataFrame, a_json: str, b_model: str, id_col="doc_id", text_col="text",
                   with_groups: bool = False, block: int = BLOCK, remember: int = WINDOWS) -> DataFrame:
    """The documents aligned, in blocks (written to the shared folder). ``a_json`` and ``b_model`` are the tokenizers'
    files on the driver; tasks get their contents."""
    text_a, proto_b = open(a_json, encoding="utf-8").read(), open(b_model, "rb").read()
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = to_arrow_schema(d.schema).field("doc_id").type
    fields = [("doc_id", id_type), *((n, pa.int64()) for n in NUMBERS), ("groups_sha256", pa.string())]
    schema = pa.schema([*fields, *([("groups", pa.large_string())] if with_groups else [])])

    def run(batches):
        cache = worker_cache(f"tabclass_align_{zlib.crc32(text_a.encode())}_{zlib.crc32(proto_b)}")
        if "aligner" not in cache:
            cache["aligner"] = Aligner(ByteLevel(text_a), Pieces(proto_b))
        aligner: Aligner = cache["aligner"]
        number, now = TaskContext.get().partitionId() << 32, Block()

        def close():
            nonlocal number, now
            out, now, number = now.rows(number, np.array(aligner.codes, np.int64)), Block(), number + 1
            if len(aligner.number) > remember:
                aligner.clear()  # pair numbers live as long as a block at least
            return out

        for b in batches:
            for part in cut(b, 1, STEP):
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows, doc, pair, linked = aligner.documents(texts)
                cols = list(zip(*rows, strict=True))
                sha = [hashlib.sha256(t).hexdigest() if t is not None else "" for t in cols[4]]
                arrays = [part.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(sha)]
                if with_groups:
                    arrays.append(pa.array([(t or b"").decode() for t in cols[4]], pa.large_string()))
                now.add(pa.RecordBatch.from_arrays(arrays, schema=schema), doc, pair, linked,
                        part.column(1).nbytes, len(aligner.codes))
                if now.size >= block or len(aligner.number) > remember:
                    yield close()
        if now.parts:
            yield close()

    return staged(d.mapInArrow(run, BLOCK_DDL), "align-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: in how many documents an id pair (A id << 32 | B id) is
    linked, and whether no pair of its A id is in more."""
    pairs = (blocks.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "held")).alias("x"))
             .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n_docs")))
    pairs = staged(pairs, "align-pairs")
    a = F.shiftright("pair", 32)
    most = pairs.groupBy(a.alias("a")).agg(F.max("n_docs").alias("most"))  # a row a token of A
    return pairs.join(most, a == F.col("a"), "left").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_json: str, b_model: str, id_col="doc_id", text_col="text", with_groups: bool = False,
          block: int = BLOCK, remember: int = WINDOWS) -> DataFrame:
    """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` and, if
    asked for, its ``groups`` as text (``a1,a2|b1;a3|b2,b3``: the A and B ids of each group)."""
    blocks = aligned_blocks(docs, a_json, b_model, id_col, text_col, with_groups, block, remember)
    counts = pair_counts(blocks)
    of_block = (blocks.where("pairs IS NOT NULL").select("block", F.explode("pairs").alias("pair"))
                .join(counts, "pair").select(F.col("block").alias("block_of"), "pair", "n_docs", "best"))
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    ddl = (f"doc_id {kind}, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string, "
           + ("groups string, " if with_groups else "") + "n_best long, count_sum long")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        n_docs = right.column("n_docs").to_numpy()[order]
        best = right.column("best").to_numpy().astype(bool)[order]
        out = []
        for d, e in zip(left.column("docs"), left.column("entries"), strict=True):
            rows, some = from_blob(d.as_py()), from_blob(e.as_py())
            key, linked = np.cumsum(some.column("step").to_numpy()), some.column("linked").to_numpy()
            sums = [np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)]
            if len(key):
                doc, pair = key // len(order), key % len(order)
                np.add.at(sums[0], doc, linked * best[pair])
                np.add.at(sums[1], doc, linked * n_docs[pair])
            out.append(pa.Table.from_arrays([*rows.columns, *map(pa.array, sums)],
                                            [*rows.schema.names, "n_best", "count_sum"]).cast(schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return (blocks.select("block", "docs", "entries").groupBy("block")
            .cogroup(of_block.groupBy("block_of")).applyInArrow(run, ddl))
