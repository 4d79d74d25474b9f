"""Rule bitmask ledger: every rule is evaluated once per document, the failures
are kept as bits beside the measurements, and policies (versioned bit masks)
and ablations are computed from the bits alone.

The measurements are row-local column expressions: words, word characters,
symbols, repeated lines, and words inside 8-word windows that occur twice. The
windows are hashes built by doubling (words to pairs, pairs to fours, fours to
eights), so a text of n words costs O(n) and no row leaves its task.

Defined results: a null or empty text has no words, all measurements are 0 and
it fails the base rules; repeated rows give repeated rows; an empty table gives
an empty ledger. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, text_of

SYMBOLS = "#*$%&|<>"
RULES = ("few_words", "repeated_windows", "symbol_heavy", "repeated_lines", "odd_word_length")
BASE_RULES = ("few_words", "repeated_windows")
#: version -> the rules that reject a document
POLICIES = {1: BASE_RULES, 2: RULES}
CURRENT = 2


def bit(rule: str) -> int:
    return 1 << RULES.index(rule)


def mask(rules) -> int:
    return sum(bit(r) for r in rules)


def _word_array(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _repeat_words(words: Column, window: int = 8) -> Column:
    """Words covered by windows of ``window`` (a power of two) that occur twice."""
    def widen(h: Column, by: int) -> Column:
        return let(h, lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - by, F.lit(0))),
                                           F.slice(x, by + 1, F.greatest(F.size(x) - by, F.lit(0))),
                                           lambda a, b: F.xxhash64(a, b)))
    h, by = F.transform(words, lambda w: F.xxhash64(w)), 1
    while by < window:
        h, by = widen(h, by), by * 2

    def covered(x: Column) -> Column:
        # positions sorted by (hash, position); a position repeats if a neighbour has its hash
        pos = F.transform(x, lambda v, i: F.struct(v.alias("h"), i.alias("i")))
        def hits(s: Column) -> Column:
            at = F.transform(s, lambda v, k: F.when(
                (F.get(s, k - 1)["h"] == v["h"]) | (F.get(s, k + 1)["h"] == v["h"]), v["i"]))
            return F.array_sort(F.array_compact(at))
        def spread(p: Column) -> Column:
            # a window covers up to the next repeated window, at most its own length
            return F.aggregate(
                F.transform(p, lambda v, k: F.least(F.coalesce(F.get(p, k + 1) - v, F.lit(window)), F.lit(window))),
                F.lit(0).cast("long"), lambda acc, v: acc + v)
        return let(let(F.array_sort(pos), hits), spread)
    return let(h, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0).cast("long"))
               .otherwise(covered(x)))


def ledger(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id``, the measurements and ``bits`` (bit i set: rule i fails)."""
    text = text_of(text_col)
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
            lambda x: F.struct(F.size(x).cast("long").alias("n"),
                               F.size(F.array_distinct(x)).cast("long").alias("d"))).alias("lines"),
        let(_word_array(text), lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                                  _repeat_words(w).alias("r"))).alias("ws"))
    m = base.select("doc_id", F.col("ws.n").alias("n_words"), "word_chars", "n_symbols",
                    (F.col("lines.n") - F.col("lines.d")).alias("n_dup_lines"), F.col("ws.r").alias("n_repeat_words"),
                    F.col("lines.n").alias("n_lines"))
    fails = {
        "few_words": F.col("n_words") < 20,
        "repeated_windows": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbol_heavy": 2 * F.col("n_symbols") > F.col("n_words"),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "odd_word_length": (F.col("word_chars") > 20 * F.col("n_words"))
        | (10 * F.col("word_chars") < 15 * F.col("n_words")),
    }
    bits = sum((F.when(fails[r], F.lit(bit(r))).otherwise(F.lit(0)) for r in RULES), F.lit(0)).cast("long")
    return m.withColumn("bits", bits)


def apply_policy(led: DataFrame, rules) -> DataFrame:
    """Adds ``kept``: no rule of the policy fails."""
    return led.withColumn("kept", F.col("bits").bitwiseAND(F.lit(mask(rules))) == 0)


def ablations(led: DataFrame, policies=POLICIES) -> DataFrame:
    """For each policy version and each of its rules: documents the policy
    rejects, those this rule alone rejects (kept if the rule were dropped), and
    those it shares. One aggregate of the bits; at most 2^rules rows follow."""
    patterns = led.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    rows = [(v, r, mask(rules), bit(r)) for v, rules in sorted(policies.items()) for r in rules]
    table = F.inline(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(r).alias("rule"),
                                        F.lit(m).cast("long").alias("m"), F.lit(b).cast("long").alias("b"))
                               for v, r, m, b in rows]))
    x = patterns.select("bits", "n", table)
    failed = F.col("bits").bitwiseAND(F.col("m"))
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0))).cast("long")
    return x.groupBy("version", "rule").agg(
        total(failed != 0).alias("rejected"), total(failed.bitwiseAND(F.col("b")) != 0).alias("rule_fails"),
        total(failed == F.col("b")).alias("only_this_rule"))


_MEASURES = r"""
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, length(ws) - 6)) AS i FROM w)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS r FROM rep, range(0, 8) t(j) WHERE k > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(length(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(length(ls) - length(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(length(ls) AS BIGINT) AS n_lines,
  CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
led AS (SELECT *, CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END
  + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END
  + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars > 20 * n_words OR 10 * word_chars < 15 * n_words THEN 16 ELSE 0 END AS BIGINT) AS bits FROM m)
"""
SQL = f"""WITH {_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits, (bits & 3) <> 0 AS base_failed,
  (bits & 31) = 0 AS kept FROM led"""
SQL_ABLATIONS = f"""WITH {_MEASURES},
p AS (SELECT * FROM (VALUES (1, 'few_words', 3, 1), (1, 'repeated_windows', 3, 2), (2, 'few_words', 31, 1),
  (2, 'repeated_windows', 31, 2), (2, 'symbol_heavy', 31, 4), (2, 'repeated_lines', 31, 8),
  (2, 'odd_word_length', 31, 16)) t(version, rule, m, b))
SELECT version, rule, CAST(count(*) FILTER ((bits & m) <> 0) AS BIGINT) AS rejected,
  CAST(count(*) FILTER ((bits & b) <> 0) AS BIGINT) AS rule_fails,
  CAST(count(*) FILTER ((bits & m) = b) AS BIGINT) AS only_this_rule FROM led, p GROUP BY version, rule"""
