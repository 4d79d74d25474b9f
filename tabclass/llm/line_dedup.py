"""Line deduplication: lines found in many documents are dropped everywhere.

Lines are exploded by document, normalised and hashed; a hash counts each document
once, summed map-side before the shuffle, so that a line which a third of all
documents share is one row of every task. Hashes at or over the threshold are
joined back to the exploded lines, by hash alone (adaptive execution splits a hot
one, or sends the frequent ones out when they are few), and tell the positions
to drop; the documents meet their positions once and are reassembled from what is
left, in order. Texts are shuffled in that last join only; everything else
moves two longs a line.

A line's hash is two independent 64-bit XXH64 values (2^-128 for a pair of lines).
A document is found again by two such values of its id and text: documents equal in
both have the same lines to drop, so repeated rows and missing ids need no row
number, and a group of copies is one row of positions.

Defined results: a null or empty text is one empty line; every row is a document
of its own, repeated rows and null ids too; keys shorter than ``min_chars`` (empty
ones at the least) are never dropped and not counted; a text whose lines all go
is the empty text; an empty table gives an empty result. All columns of the documents
are carried along; new columns that clash with them get leading underscores.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, fresh, text_of

MIN_DOCUMENTS = 10
MIN_CHARS = 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text_col: str) -> Column:
    return F.split(text_of(text_col), "\n", -1)


def two_hashes(*cols: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *cols) for seed in (1, 2)]


def frequent_lines(docs: DataFrame, text_col="text", min_documents: int = MIN_DOCUMENTS,
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1, h2, n_documents`` of each line found in ``min_documents`` documents or more."""
    keys = F.filter(F.transform(lines_of(text_col), line_key), lambda k: F.length(k) >= max(1, min_chars))
    h1, h2 = two_hashes(F.col("key"))
    return (docs.select(F.explode(F.array_distinct(keys)).alias("key")).select(h1.alias("h1"), h2.alias("h2"))
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_documents"))
            .where(F.col("n_documents") >= min_documents))


def drop_common_lines(docs: DataFrame, id_col="doc_id", text_col="text", min_documents: int = MIN_DOCUMENTS,
                      min_chars: int = MIN_CHARS) -> tuple[DataFrame, str, str]:
    """``docs`` with the text that is left, and the names of two further columns: its
    number of lines before, and of those dropped."""
    d1, d2, gone, n_lines, n_dropped = fresh(docs, "_d1", "_d2", "_gone", "n_lines", "n_dropped")
    own = [c.alias(n) for c, n in zip(two_hashes(F.col(id_col).cast("string"), text_of(text_col)), (d1, d2),
                                      strict=True)]
    # positions to drop, from 1; a set, so that copies of a document do not pile up
    at = docs.select(*own, F.posexplode(F.transform(lines_of(text_col), line_key)).alias("pos", "key"))
    h1, h2 = two_hashes(F.col("key"))
    at = (at.where(F.length("key") >= max(1, min_chars))
          .select(d1, d2, (F.col("pos") + 1).alias("pos"), h1.alias("h1"), h2.alias("h2")))
    often = frequent_lines(docs, text_col, min_documents, min_chars).select("h1", "h2")
    drops = (at.join(often, ["h1", "h2"]).groupBy(d1, d2).agg(F.collect_set("pos").alias(gone)))
    out = docs.withColumns({d1: own[0], d2: own[1]}).join(drops, [d1, d2], "left")
    lines, some = lines_of(text_col), F.col(gone).isNotNull()
    left = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.col(gone))  # keeps its order
    text = F.when(some, F.array_join(F.transform(left, lambda i: F.element_at(lines, i)), "\n"))
    return out.select(*[F.coalesce(text, text_of(text_col)).alias(c) if c == text_col else F.col(f"`{c}`")
                        for c in docs.columns],
                      F.size(lines).cast("long").alias(n_lines),
                      F.when(some, F.size(gone)).otherwise(0).cast("long").alias(n_dropped)), n_lines, n_dropped


#: the registered query in DuckDB
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT rid) >= {MIN_DOCUMENTS})
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY rid
"""
