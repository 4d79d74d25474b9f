"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt in id order into shards of at most ``SHARD`` of them. In a shard an
index holds, for each (position, turn), the bitset of the conversations that have
this turn there. A depth-first walk starts with the bitset of the whole shard:
the lowest member left names a child by its turn, the child's members are the
parent's bitset and that turn's postings, and they are struck off; popcounts give
the members, and the members without a turn at the position are the end list. A shard's rows come
sorted by position and are indexed slab by slab, the open nodes of one slab
being the roots of the next, so a task holds a slab and at most ``SHARD``
open nodes, however long a conversation is.

Nodes of different shards are one node when their paths are equal: a path's key is a
128-bit digest chained over its turns. The shards' rows meet sorted by (key,
shard), so counts add up, the first row has the smallest member, and end lists follow each other in
id order; they stream through one digest and are never gathered. A
prefix that a third of all conversations share is one row of each shard there.

Sums over subtrees go up by pointer doubling over the nodes with two members and
more: what lies below a node with one member is a chain, one leaf that saves
nothing. So rounds grow with the logarithm of the longest shared prefix.

Defined results: turns are ordered by turn, null first, and turns alike in that by their
digest; null roles and texts are empty; rows without a conversation id are of no
conversation; repeated rows are turns of their own; a conversation without turns ends at
the root; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rank_within
from .common import parts_for, staged

SHARD = 4096
SLAB_ROWS = 1 << 16
ROOT = hashlib.md5(b"").digest()
RUN = 12  # turns are ranked in runs of 2^RUN turn numbers


def digest_of(role: str, text: str) -> Column:
    """md5 of a turn; the role's length keeps role and text apart."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return F.unhex(F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)))


def ordered_turns(turns: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """``conv_id, pos, digest, chars``: positions from 0 by (turn, digest). A long
    conversation is ranked in runs of turn numbers, turns without one by their digests."""
    t = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest_of(role, text).alias("digest"),
        F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long").alias("chars"))
    t = staged(t, "trie-digests")
    part = F.when(F.col("turn").isNull(), F.conv(F.substring(F.hex("digest"), 1, 3), 16, 10).cast("long")
                  + F.lit(-(1 << 62))).otherwise(F.shiftright(F.col("turn").cast("long"), RUN))
    ranked = rank_within(t, "conv_id", [F.col("turn").asc_nulls_first(), "digest"], out="pos", bucket=part)
    return ranked.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "chars")


def with_shared_heads(ordered: DataFrame, heads: Column, group: int = 100, most: int = 5) -> DataFrame:
    """Conversations rebuilt: the first ``heads`` (a column over ``conv_id``, at
    most ``most``) turns are those of conversation ``conv_id - conv_id % group``, the others
    its own. ``conv_id, pos, digest, chars``, and a row without digest and position for a
    conversation that is left without turns."""
    convs = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", heads.cast("long"))
    own = ordered.where(F.col("pos") >= heads)
    lead = ordered.where((F.col("pos") < most) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("lead"), "pos", "digest", "chars")
    sized = convs.select(F.col("conv_id").alias("lead"), F.col("n").alias("n_lead"))
    convs = (convs.withColumn("lead", F.col("conv_id") - F.col("conv_id") % group).join(sized, "lead", "left")
             .withColumn("got", F.least("h", F.coalesce("n_lead", F.lit(0)))))
    taken = (convs.where("got > 0").join(lead, "lead").where("pos < got")
             .select("conv_id", "pos", "digest", "chars"))
    # own turns move up when the lead conversation is shorter than the head
    moved = own.join(convs.where("got < h").select("conv_id", "h", "got"), "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce(F.col("h") - F.col("got"), F.lit(0))).alias("pos"), "digest", "chars")
    none = convs.where("got = 0 AND n <= h").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("chars"))
    return taken.unionByName(moved).unionByName(none)


# ------------------------------------------------------------------ one shard
class Shard:
    """The walk of one shard. ``open`` are the nodes at the top of the next slab:
    (key, depth, members)."""

    def __init__(self, emit):
        self.emit, self.ids, self.open = emit, [], []

    def begin(self, ids: list[int]):
        """``ids``: the shard's conversations in order; a bit is a place in this list."""
        self.ids, members = ids, (1 << len(ids)) - 1
        self.place = {c: i for i, c in enumerate(ids)}
        self.open = [(ROOT, None, 0, members, 0)]

    def slab(self, first: int, rows: list[tuple[int, int, bytes, int]], last: bool):
        """``rows``: (conv_id, pos, digest, chars) of the positions from ``first`` on, whole
        positions each. After the ``last`` slab every open node ends there."""
        postings: dict[tuple[int, bytes], int] = {}  # (position, turn) -> bitset
        turn_of: dict[tuple[int, int], tuple[bytes, int]] = {}
        there: dict[int, int] = {}  # position -> bitset of the conversations that have it
        for c, pos, digest, chars in rows:
            b = self.place[c]
            postings[pos, digest] = postings.get((pos, digest), 0) | 1 << b
            there[pos] = there.get(pos, 0) | 1 << b
            turn_of[pos, b] = digest, chars
        end = max(there, default=first - 1) + 1
        stack, self.open = self.open[::-1], []
        while stack:
            node = key, parent, depth, members, chars = stack.pop()
            if depth >= end and not last:
                self.open.append(node)
                continue
            on = members & there.get(depth, 0)
            self.emit(key, parent, depth, members.bit_count(), self.ids[low(members)], chars,
                      self.listed(members & ~on))
            below = []
            while on:
                digest, n = turn_of[depth, low(on)]
                child = on & postings[depth, digest]
                on ^= child
                below.append((hashlib.md5(key + digest).digest(), key, depth + 1, child, n))
            stack += below[::-1]

    def listed(self, members: int) -> str:
        out = []
        while members:
            b = low(members)
            out.append(str(self.ids[b]))
            members &= members - 1
        return ",".join(out)


def low(bits: int) -> int:
    """Place of the lowest bit."""
    return (bits & -bits).bit_length() - 1


NODE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()),
                  ("conv_id", pa.int64()), ("chars", pa.int64()), ("ends", pa.string()), ("shard", pa.int64())])
NODE_DDL = ("key binary, parent binary, depth long, n long, conv_id long, chars long, ends string, shard long")


def walk_shards(slab_rows: int):
    """Batches sorted by (shard, kind, pos, conv_id): first a shard's conversations
    (pos -1), then its turns."""

    def run(batches):
        out: list[tuple] = []
        shard, at, ids, rows, walk = None, 0, [], [], None

        def emit(*node):
            out.append((*node, shard))

        def batch():
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), NODE, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=NODE)

        def start():
            w = Shard(emit)
            w.begin(ids)
            return w

        for b in batches:
            cols = (b.column(n).to_pylist() for n in ("shard", "pos", "conv_id", "digest", "chars"))
            for s, pos, c, digest, chars in zip(*cols, strict=True):
                if s != shard:
                    if shard is not None:
                        (walk or start()).slab(at, rows, True)
                    shard, at, ids, rows, walk = s, 0, [], [], None
                if pos < 0:
                    ids.append(c)
                    continue
                if rows and pos != rows[-1][1] and len(rows) >= slab_rows:
                    walk = walk or start()
                    walk.slab(at, rows, False)
                    at, rows = pos, []
                rows.append((c, pos, digest, chars))
                if len(out) >= 8192:
                    yield batch()
        if shard is not None:
            (walk or start()).slab(at, rows, True)
        while out:
            yield batch()

    return run


def merge_nodes(batches):
    """Batches sorted by (key, shard) -> a row a node; the end lists stream through the digest."""
    rows: list[tuple] = []
    now: list | None = None  # key, parent, depth, n, conv_id, chars, has ends
    sha = hashlib.sha256()
    schema = pa.schema([*list(NODE)[:6], ("childless", pa.bool_()), ("ends_sha256", pa.string())])

    def close():
        # without a turn further on every member ends here
        rows.append((*now[:6], now[6] == now[3], sha.hexdigest()))

    def batch():
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for b in batches:
        cols = (b.column(i).to_pylist() for i in range(7))
        for key, parent, depth, n, conv, chars, ends in zip(*cols, strict=True):
            if now is None or key != now[0]:
                if now is not None:
                    close()
                now, sha = [key, parent, depth, 0, conv, chars, 0], hashlib.sha256()
            now[3] += n
            if ends:
                sha.update((("," if now[6] else "") + ends).encode())
                now[6] += ends.count(",") + 1
        if len(rows) >= 8192:
            yield batch()
    if now is not None:
        close()
    if rows:
        yield batch()


MERGED_DDL = ("key binary, parent binary, depth long, n long, conv_id long, chars long, childless boolean, "
              "ends_sha256 string")


def subtree_sums(shared: DataFrame) -> DataFrame:
    """``key, parent, leaves, saved`` rows -> the sums over each row's subtree, by
    doubling: after round k a row has summed all that is less than 2^k below it."""
    t = staged(shared.withColumnRenamed("parent", "up"), "trie-sums")
    rounds = 0
    while not t.where("up IS NOT NULL").isEmpty():
        more = (t.where("up IS NOT NULL").groupBy(F.col("up").alias("key"))
                .agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")))
        ups = t.select(F.col("key").alias("up"), F.col("up").alias("next_up"))
        t = staged(t.join(more, "key", "left").join(ups, "up", "left").select(
            "key", F.col("next_up").alias("up"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), f"trie-sums-{rounds}")
        rounds += 1
    return t.select("key", "leaves", "saved")


def trie(rebuilt: DataFrame, shard: int = SHARD, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """``conv_id, pos, digest, chars`` rows (digest null: a conversation without turns) -> a row a node:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = rebuilt.sparkSession
    turns = staged(rebuilt, "trie-turns")
    rows = turns.count()
    parts = parts_for(spark, rows * 64, 64 << 20)
    # ids in order: the partition and the place there number them, a shard is a run of them
    ids = turns.select("conv_id").distinct().repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id")
    m = F.monotonically_increasing_id()
    convs = staged(ids.select("conv_id", m.alias("m")).select(
        "conv_id", (F.shiftrightunsigned("m", 33) * F.lit(1 << 33)
                    + F.floor(F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) / shard)).cast("long").alias("shard")),
        "trie-convs")
    placed = turns.where("digest IS NOT NULL").join(convs, "conv_id")
    heads = convs.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"),
                         F.lit(0).cast("long").alias("chars"), "shard")
    sorted_ = (placed.select(heads.columns).unionByName(heads).repartition(parts, "shard")
               .sortWithinPartitions("shard", "pos", "conv_id"))
    pieces = sorted_.mapInArrow(walk_shards(slab_rows), NODE_DDL)
    merged = (pieces.repartition(parts, "key").sortWithinPartitions("key", "shard")
              .mapInArrow(merge_nodes, MERGED_DDL))
    nodes = staged(merged, "trie-nodes")

    children = (nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
                .agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n") == 1).alias("single")))
    shared = nodes.where("n > 1").join(children, "key", "left").select(
        "key", "parent", F.when(F.col("childless"), 1).otherwise(F.col("single")).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    sums = subtree_sums(shared)
    tops = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(tops, "parent", "left").join(children.drop("single"), "key", "left").join(sums, "key", "left")
            .select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                    F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
                    F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), "ends_sha256"))


def heads_by_crc(modulus: int = 6) -> Column:
    """How many head turns a conversation takes over: crc32 of its decimal id, modulo."""
    return F.crc32(F.col("conv_id").cast("string")) % modulus


#: the registered query in DuckDB; crc32 bit by bit over the id's digits
SQL = """
WITH t AS (SELECT conv_id::BIGINT AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST,
                                   md5(length(role)::VARCHAR || ':' || role || text)) - 1 AS pos FROM t),
ids AS (SELECT DISTINCT c, c - c % 100 AS lead,
        xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
            lambda x: [ascii(x)::UBIGINT, 999, 999, 999, 999, 999, 999, 999, 999]::UBIGINT[]))),
            lambda a, e: CASE WHEN e = 999 THEN xor(a >> 1, 3988292384::UBIGINT * (a & 1)) ELSE xor(a, e) END),
            4294967295::UBIGINT) % 6 AS h FROM t),
r AS (SELECT i.c, o.pos, o.role, o.text FROM ids i JOIN o ON o.c = i.lead AND o.pos < i.h
      UNION ALL SELECT i.c, o.pos + 1000000, o.role, o.text FROM ids i JOIN o ON o.c = i.c AND o.pos >= i.h),
p AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, role, text FROM r),
chain AS (SELECT c, d, length(text) AS chars, string_agg(md5(length(role)::VARCHAR || ':' || role || text), '/')
          OVER (PARTITION BY c ORDER BY d) AS path FROM p
          UNION ALL SELECT c, 0, 0, '' FROM ids),
last AS (SELECT c, max(d) AS n FROM chain GROUP BY c),
node AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256
         FROM chain JOIN last USING (c) GROUP BY path, d),
member AS (SELECT k.c, k.d, n.path, n.conv_id, n.n_convs, n.chars FROM chain k JOIN node n ON n.path = k.path AND n.d = k.d),
up AS (SELECT DISTINCT m.path, a.conv_id AS parent_conv_id, a.path AS parent FROM member m
       JOIN member a ON a.c = m.c AND a.d = m.d - 1),
kids AS (SELECT parent, count(*) AS n_children FROM up GROUP BY parent),
below AS (SELECT DISTINCT a.path, m.path AS sub, (m.n_convs - 1) * m.chars AS saved FROM member a
          JOIN member m ON m.c = a.c AND m.d >= a.d),
sums AS (SELECT b.path, count(*) FILTER (WHERE k.parent IS NULL) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
         FROM below b LEFT JOIN kids k ON k.parent = b.sub GROUP BY b.path)
SELECT n.conv_id, n.d::BIGINT AS depth, u.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens, n.ends_sha256
FROM node n JOIN sums s ON s.path = n.path LEFT JOIN up u ON u.path = n.path LEFT JOIN kids k ON k.parent = n.path
"""
