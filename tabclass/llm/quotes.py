"""Quotation linking: messages find what they quote, and conversations are
rebuilt in reply order without the quotes.

Lines are parsed into quote levels by their leading ``>`` marks. A level-0 line
is the message's own; quoted lines are normalised (marks off, white space
collapsed, lower case) and hashed; empty ones do not count. A passage is a run
of quoted lines of one level. A message wrote a passage if the passage's lines
stand in it one after the other, quotes left out; the first turn of the quoter's
own conversation that did so before it is the passage's original, else the first
message of the smallest other conversation that did.

Per level, the whole quote (all passages of the level in order, as when a reply
is written between the parts) is looked up first; where nobody wrote that, each
passage; where nobody wrote that passage either, each of its lines. Originals
get a vote for every line found this way; the one with most votes at the
outermost level found is the parent (ties: smallest conversation, then turn).
Without a link the parent is the previous turn. Quotes across conversations may
close a ring; a ring is broken at its smallest (conversation, turn), which then
has no parent.

A passage of k lines is known by the hashes of its first and last p lines, p the
greatest power of two up to k. Originals offer windows of the sizes that occur
only, and of these only the hashes that some quote has; a window meets each
length at most once, never each quote, and writers are reduced to the first one
of each conversation and of the table before the quotes meet them. So a line
that a third of all messages share meets each quote once. Depths come from
pointer doubling, threads from the components of linked conversations; both
write each step to the shared folder. No window or list per conversation is
built, so one conversation may be of any length.

Defined results: a null text is an empty body; rows that repeat (conv_id, turn)
are one message (the smallest text); a message without conv_id or turn has no
parent and depth 0; a quote of what nobody wrote has no link; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import SPACES, staged
from .graph import components

MARKS = r"^[ \t]*(?:>[ \t]?)+"
WROTE = r"(?i)^.*\bwrote:[ \t]*$"
#: how much of a level is looked up as one passage
WHOLE, RUN, LINE = 0, 1, 2
BATCH = 20_000
KEY = ["h1", "h2", "rest"]


def normalised(line: Column) -> Column:
    """The line without marks, white space collapsed, lower case."""
    bare = F.regexp_replace(line, MARKS, "")
    return F.trim(F.lower(F.regexp_replace(bare, r"[\x20\x09-\x0D]+", " ")))


def quote_level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def messages(conv: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per (conv_id, turn): ``conv_id, turn, role, body, own, lines``; ``own``
    are the md5 of its own lines, ``lines`` (level, md5) of all its lines, empty ones
    left out. A line that ends in "wrote:" right before a quote belongs to the quote."""
    m = conv.groupBy(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn")).agg(
        F.min(F.struct(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(role_col).cast("string").alias("role"))).alias("m"))
    lines = F.transform(F.split("m.text", "\n", -1), lambda x: F.struct(quote_level(x).alias("level"), x.alias("line")))
    m = m.select("conv_id", "turn", "m.role", lines.alias("lines"))
    own = F.filter("lines", lambda x, i: (x["level"] == 0) & ~F.coalesce(
        x["line"].rlike(WROTE) & (F.get("lines", i + 1)["level"] > 0), F.lit(False)))
    texts = F.transform(own, lambda x: x["line"])
    full = F.transform(F.filter("lines", lambda x: normalised(x["line"]) != ""),
                       lambda x: F.struct(x["level"].cast("int").alias("level"), F.md5(normalised(x["line"])).alias("hash")))
    return m.select("conv_id", "turn", "role", F.trim(F.array_join(texts, "\n"), F.lit(SPACES)).alias("body"),
                    F.transform(F.filter(texts, lambda x: normalised(x) != ""), lambda x: F.md5(normalised(x))).alias("own"),
                    full.alias("lines"))


def _pair(a: str, b: str) -> str:
    return hashlib.md5((a + b).encode()).hexdigest()


def _window(hashes: list[str]) -> str:
    """The hash of a power of two of lines: halves are hashed first."""
    while len(hashes) > 1:
        hashes = [_pair(hashes[i], hashes[i + 1]) for i in range(0, len(hashes), 2)]
    return hashes[0]


def _unit(hashes: list[str]) -> tuple:
    """(size, rest, first window, last window) of a passage."""
    size = 1 << (len(hashes).bit_length() - 1)
    return size, len(hashes) - size, _window(hashes[:size]), _window(hashes[len(hashes) - size:])


def _quoted_units(lines):
    """(level, tier, run, lines, unit) of all that one message quotes."""
    levels, runs = {}, []
    before = 0
    for x in lines:
        level, line = x["level"], x["hash"]
        if level > 0:
            levels.setdefault(level, []).append(line)
            if level != before:
                runs.append((level, []))
            runs[-1][1].append(line)
        before = level
    for level, hashes in levels.items():
        yield level, WHOLE, -1, len(hashes), _unit(hashes)
    for i, (level, hashes) in enumerate(runs):
        yield level, RUN, i, len(hashes), _unit(hashes)
        for line in hashes:
            yield level, LINE, i, 1, (1, 0, line, line)


def _windows(own: list[str], sizes: frozenset):
    """(size, position, hash) of a message's own lines, for the sizes asked for."""
    now, size = own, 1
    while now:
        if size in sizes:
            yield from ((size, i, h) for i, h in enumerate(now))
        if size >= max(sizes, default=0):
            return
        now = [_pair(now[i], now[i + size]) for i in range(len(now) - size)]
        size *= 2


def _spread(m: DataFrame, col: str, make, columns: str) -> DataFrame:
    """``conv_id, turn`` and the columns of the rows that ``make`` draws from ``col``."""
    names = ["conv_id", "turn", *(c.split()[0] for c in columns.split(", "))]

    def run(frames):
        out = []
        for f in frames:
            for conv, turn, value in zip(f["conv_id"], f["turn"], f[col], strict=True):
                for row in make(value):
                    out.append((conv, turn, *row))
                    if len(out) >= BATCH:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    schema = StructType.fromDDL(columns)
    return m.select("conv_id", "turn", col).mapInPandas(
        run, StructType([m.schema["conv_id"], m.schema["turn"], *schema.fields]))


def writers(m: DataFrame, units: DataFrame) -> DataFrame:
    """``h1, h2, rest, conv_id, turn``: per passage of ``units`` and conversation the
    first turn that wrote it."""
    sizes = frozenset(r[0] for r in units.select("size").distinct().collect())  # powers of two: a few dozen at most
    asked = units.select(F.explode(F.array("h1", "h2")).alias("hash")).distinct()
    win = _spread(m, "own", lambda own: _windows(list(own), sizes), "size int, pos int, hash string")
    win = staged(win.join(asked, "hash", "left_semi"), "quote-windows")
    lengths = units.select(F.col("h1").alias("hash"), "rest").distinct()
    at = win.join(lengths, "hash")
    end = win.select("conv_id", "turn", "size", F.col("pos").alias("at"), F.col("hash").alias("h2"))
    longer = (at.where("rest > 0").withColumn("at", F.col("pos") + F.col("rest"))
              .join(end, ["conv_id", "turn", "size", "at"]))
    hits = (at.where("rest = 0").select(F.col("hash").alias("h1"), F.col("hash").alias("h2"), "rest", "conv_id", "turn")
            .unionByName(longer.select(F.col("hash").alias("h1"), "h2", "rest", "conv_id", "turn")))
    return hits.groupBy(*KEY, "conv_id").agg(F.min("turn").alias("turn"))


def parents(m: DataFrame) -> DataFrame:
    """``conv_id, turn, p_conv, p_turn, n_linked`` for messages whose quotes are found."""
    m = m.where("conv_id is not null and turn is not null")
    units = staged(_spread(m.where(F.exists("lines", lambda x: x["level"] > 0)), "lines", lambda lines: (
        (*u, *key) for *u, key in _quoted_units(lines)),
        "level int, tier int, run int, k int, size int, rest int, h1 string, h2 string"), "quote-units")
    here = staged(writers(m, units), "quote-writers")
    first = here.groupBy(*KEY).agg(F.min(F.struct("conv_id", "turn")).alias("f"))
    second = (here.join(first, KEY).where("conv_id <> f.conv_id").groupBy(*KEY)
              .agg(F.min(F.struct("conv_id", "turn")).alias("s")))
    q = units.join(here.withColumnRenamed("turn", "h_turn"), [*KEY, "conv_id"], "left")
    q = q.join(first.join(second, KEY, "left"), KEY, "left")
    target = (F.when(F.col("h_turn") < F.col("turn"), F.struct(F.col("conv_id"), F.col("h_turn").alias("turn")))
              .when(F.col("f.conv_id") != F.col("conv_id"), F.col("f")).otherwise(F.col("s")))
    found = staged(q.select("conv_id", "turn", "level", "tier", "run", "k", target.alias("to")).where("to is not null"),
                   "quote-found")
    at_level, at_run = ["conv_id", "turn", "level"], ["conv_id", "turn", "run"]
    whole, run = found.where(f"tier = {WHOLE}"), found.where(f"tier = {RUN}")
    part = found.where(f"tier <> {WHOLE}").join(whole.select(*at_level), at_level, "left_anti")
    line = part.where(f"tier = {LINE}").join(run.select(*at_run), at_run, "left_anti")
    hits = whole.unionByName(part.where(f"tier = {RUN}").select(*whole.columns)).unionByName(line.select(*whole.columns))
    votes = hits.groupBy("conv_id", "turn", "level", "to").agg(F.sum("k").alias("n"))
    best = F.min_by("to", F.struct("level", -F.col("n"), "to"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("to"), F.sum("n").alias("n_linked")).select(
        "conv_id", "turn", F.col("to.conv_id").alias("p_conv"), F.col("to.turn").alias("p_turn"), "n_linked")


def _depths(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, turn, depth`` by pointer doubling, and the smallest message of
    each ring (``conv_id, turn``; none if there are no rings, else the depths below
    a ring are not right yet). Who still has an ancestor after as many steps as there
    are messages is in a ring or below one; that ancestor is in the ring, its smallest
    message seen on the way is the ring's."""
    p = staged(links.select("conv_id", "turn", F.col("p_conv").alias("a_conv"), F.col("p_turn").alias("a_turn"),
                            F.when(F.col("p_conv").isNull(), 0).otherwise(1).cast("long").alias("depth"),
                            F.struct("conv_id", "turn").alias("low")), "quote-depth")
    n, reach = p.count(), 1
    while reach <= n and not p.where("a_conv is not null").isEmpty():
        up = p.select(F.col("conv_id").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("a_conv").alias("n_conv"),
                      F.col("a_turn").alias("n_turn"), F.col("depth").alias("more"), F.col("low").alias("u_low"))
        going = p.where("a_conv is not null").join(
            up, (F.col("a_conv") == F.col("u_conv")) & (F.col("a_turn") == F.col("u_turn")), "left")
        going = going.select("conv_id", "turn", F.col("n_conv").alias("a_conv"), F.col("n_turn").alias("a_turn"),
                             (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                             F.least("low", "u_low").alias("low"))
        p = staged(p.where("a_conv is null").unionByName(going), "quote-depth")
        reach *= 2
    ring = p.where("a_conv is not null").select(F.col("a_conv").alias("conv_id"), F.col("a_turn").alias("turn")).distinct()
    return p.select("conv_id", "turn", "depth"), p.join(ring, ["conv_id", "turn"]).select("low.*").distinct()


def reply_threads(conv: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per message: ``thread_id`` (smallest conversation linked with
    its own), ``depth`` (ancestors), parent, role, ``body`` without quotes,
    quoted and linked lines. Reply order is (thread_id, depth, conv_id, turn):
    every message comes after its parent."""
    m = staged(messages(conv, conv_col, turn_col, role_col, text_col), "quote-messages")
    linked = parents(m)
    before = m.where("conv_id is not null and turn is not null").select(
        F.col("conv_id").alias("b_conv"), F.col("turn").alias("b_turn"))
    x = (m.select("conv_id", "turn").join(linked, ["conv_id", "turn"], "left")
         .join(before, (F.col("conv_id") == F.col("b_conv")) & (F.col("turn") - 1 == F.col("b_turn")), "left"))
    x = staged(x.select("conv_id", "turn", F.coalesce("p_conv", "b_conv").alias("p_conv"),
                        F.coalesce("p_turn", "b_turn").alias("p_turn"),
                        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")), "quote-links")
    across = x.where("p_conv <> conv_id").select(F.col("conv_id").alias("a"), F.col("p_conv").alias("b"))
    threads = components(across, "quote-threads")
    known = "conv_id is not null and turn is not null"
    d, rings = _depths(x.where(known))
    if not rings.isEmpty():
        x = x.join(rings.withColumn("top", F.lit(True)), ["conv_id", "turn"], "left")
        keep = F.col("top").isNull()
        x = staged(x.select("conv_id", "turn", F.when(keep, F.col("p_conv")).alias("p_conv"),
                            F.when(keep, F.col("p_turn")).alias("p_turn"), "n_linked"), "quote-links")
        d, _ = _depths(x.where(known))
    n_quoted = F.size(F.filter("lines", lambda line: line["level"] > 0)).cast("long")
    out = (m.select("conv_id", "turn", "role", "body", n_quoted.alias("n_quoted"))
           .join(x, (m.conv_id.eqNullSafe(x.conv_id)) & (m.turn.eqNullSafe(x.turn)))
           .select(m.conv_id, m.turn, "role", "body", "n_quoted", "n_linked", "p_conv", "p_turn"))
    out = out.join(d, ["conv_id", "turn"], "left").join(threads, F.col("conv_id") == F.col("node"), "left")
    return out.select(F.coalesce("root", "conv_id").alias("thread_id"), F.coalesce("depth", F.lit(0)).alias("depth"),
                      "conv_id", "turn", "role", F.col("p_conv").alias("parent_conv"), F.col("p_turn").alias("parent_turn"),
                      "body", "n_quoted", "n_linked")


#: the same by recursion over replies and linked conversations
SQL = r"""
WITH RECURSIVE
m AS (SELECT conv_id, turn, min(struct_pack(text := coalesce(text, ''), role := role)) AS m
      FROM conversations GROUP BY conv_id, turn),
l0 AS (SELECT conv_id, turn, unnest(range(1, length(p) + 1)) AS i, unnest(p) AS line
       FROM (SELECT conv_id, turn, string_split(m.text, chr(10)) AS p FROM m)),
l1 AS (SELECT *, length(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+'))
         - length(replace(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+'), '>', '')) AS level,
         trim(lower(regexp_replace(regexp_replace(line, '^[ \t]*(?:>[ \t]?)+', ''), '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
       FROM l0),
l AS (SELECT *, lead(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS after FROM l1),
own AS (SELECT * FROM l WHERE level = 0
        AND NOT (coalesce(after, 0) > 0 AND regexp_matches(line, '(?i)^.*\bwrote:[ \t]*$'))),
body AS (SELECT conv_id, turn, trim(string_agg(line, chr(10) ORDER BY i), ' ' || chr(9) || chr(10) || chr(11) || chr(12)
         || chr(13)) AS body FROM own GROUP BY conv_id, turn),
nb AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i)
         - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY i) AS run FROM l WHERE norm <> ''),
q AS (SELECT * FROM nb WHERE level > 0),
u AS (SELECT conv_id, turn, level, 0 AS tier, -1 AS run, list(norm ORDER BY i) AS ls FROM q GROUP BY conv_id, turn, level
      UNION ALL SELECT conv_id, turn, level, 1, run, list(norm ORDER BY i) FROM q GROUP BY conv_id, turn, level, run
      UNION ALL SELECT conv_id, turn, level, 2, run, [norm] FROM q),
ol AS (SELECT conv_id, turn, norm, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i) AS pos FROM own
       WHERE norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
ow AS (SELECT conv_id, turn, list(norm ORDER BY pos) AS own FROM ol GROUP BY conv_id, turn),
w AS (SELECT DISTINCT un.ls, ow.conv_id, ow.turn FROM (SELECT DISTINCT ls FROM u) un JOIN ol ON ol.norm = un.ls[1]
      JOIN ow ON ow.conv_id = ol.conv_id AND ow.turn = ol.turn
      WHERE list_slice(ow.own, ol.pos, ol.pos + length(un.ls) - 1) = un.ls),
here AS (SELECT ls, conv_id, min(turn) AS h FROM w GROUP BY ls, conv_id),
f1 AS (SELECT ls, min(struct_pack(c := conv_id, t := turn)) AS f FROM w GROUP BY ls),
f2 AS (SELECT w.ls, min(struct_pack(c := conv_id, t := turn)) AS s FROM w JOIN f1 ON f1.ls = w.ls
       WHERE w.conv_id <> f1.f.c GROUP BY w.ls),
hit AS (SELECT u.*, CASE WHEN here.h < u.turn THEN struct_pack(c := u.conv_id, t := here.h)
          WHEN f1.f.c <> u.conv_id THEN f1.f ELSE f2.s END AS go
        FROM u LEFT JOIN here ON here.ls = u.ls AND here.conv_id = u.conv_id LEFT JOIN f1 ON f1.ls = u.ls
        LEFT JOIN f2 ON f2.ls = u.ls WHERE u.conv_id IS NOT NULL AND u.turn IS NOT NULL),
found AS (SELECT * FROM hit WHERE go IS NOT NULL),
used AS (SELECT * FROM found a WHERE tier = 0 OR (
  NOT EXISTS (SELECT 1 FROM found b WHERE b.tier = 0 AND b.conv_id = a.conv_id AND b.turn = a.turn AND b.level = a.level)
  AND (tier = 1 OR NOT EXISTS (SELECT 1 FROM found b WHERE b.tier = 1 AND b.conv_id = a.conv_id AND b.turn = a.turn
                               AND b.level = a.level AND b.run = a.run)))),
vote AS (SELECT conv_id, turn, level, go, sum(length(ls)) AS n FROM used GROUP BY ALL),
link AS (SELECT conv_id, turn, min(struct_pack(l := level, n := -n, go := go)).go AS go, sum(n) AS n_linked
         FROM vote GROUP BY conv_id, turn),
x0 AS (SELECT m.conv_id, m.turn, m.m.role AS role, coalesce(link.go.c, b.conv_id) AS parent_conv,
        coalesce(link.go.t, b.turn) AS parent_turn, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked
      FROM m LEFT JOIN link ON link.conv_id = m.conv_id AND link.turn = m.turn
      LEFT JOIN m b ON b.conv_id = m.conv_id AND b.turn = m.turn - 1),
walk(c0, t0, c, t) AS (SELECT conv_id, turn, parent_conv, parent_turn FROM x0 WHERE parent_conv <> conv_id
  UNION SELECT c0, t0, x0.parent_conv, x0.parent_turn FROM walk JOIN x0 ON x0.conv_id = walk.c AND x0.turn = walk.t
  WHERE x0.parent_conv IS NOT NULL),
ring AS (SELECT DISTINCT min(struct_pack(c := c, t := t)) AS top FROM walk GROUP BY c0, t0
         HAVING bool_or(c = c0 AND t = t0)),
x AS (SELECT x0.* REPLACE (CASE WHEN top IS NULL THEN parent_conv END AS parent_conv,
                           CASE WHEN top IS NULL THEN parent_turn END AS parent_turn)
      FROM x0 LEFT JOIN ring ON ring.top.c = x0.conv_id AND ring.top.t = x0.turn),
edge AS (SELECT DISTINCT conv_id AS a, parent_conv AS b FROM x0 WHERE parent_conv <> conv_id
         UNION SELECT DISTINCT parent_conv, conv_id FROM x0 WHERE parent_conv <> conv_id),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
thread AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
depth(conv_id, turn, depth) AS (SELECT conv_id, turn, CAST(0 AS BIGINT) FROM x WHERE parent_conv IS NULL
  UNION ALL SELECT x.conv_id, x.turn, depth.depth + 1 FROM x JOIN depth
  ON x.parent_conv = depth.conv_id AND x.parent_turn = depth.turn)
SELECT coalesce(thread.root, x.conv_id) AS thread_id, coalesce(depth.depth, 0) AS depth, x.conv_id, x.turn, x.role,
  x.parent_conv, x.parent_turn, coalesce(body.body, '') AS body,
  (SELECT count(*) FROM q WHERE q.conv_id IS NOT DISTINCT FROM x.conv_id AND q.turn IS NOT DISTINCT FROM x.turn) AS n_quoted,
  x.n_linked
FROM x LEFT JOIN thread ON thread.a = x.conv_id LEFT JOIN depth ON depth.conv_id IS NOT DISTINCT FROM x.conv_id
  AND depth.turn IS NOT DISTINCT FROM x.turn
LEFT JOIN body ON body.conv_id IS NOT DISTINCT FROM x.conv_id AND body.turn IS NOT DISTINCT FROM x.turn
"""
