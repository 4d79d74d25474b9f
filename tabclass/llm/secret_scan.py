"""Secret scan with corpus-wide ownership frequency.

Spans of every kind are found row by row. Each secret value is then hashed and
counted over the corpus: in how many repositories and by how many owners it
occurs. A value that many owners carry in many repositories is a copied example;
a value that one owner alone has, in few repositories and with enough different
characters, looks live (in many of the owner's repositories it is a template).

Counting goes in steps that combine on the map side, (hash, owner, repository)
to (hash, owner) to (hash), so a value that a third of all rows carry never
meets in one task; its verdict is joined back by a join that adaptive execution
may split.

Spans are positions in code points, end exclusive. Matches of a kind are taken
from the left without overlap; failing ones are used up, then dropped. They are
found natively: matches are wrapped in control characters (which the text is
first freed of, one for one) and the text is cut there.

Defined results: a null text has no spans; a null owner or repository counts as
one value; repeated rows repeat their spans; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, staged, text_of

# Kind, what stands before the secret, the secret, shortest secret (0: whole match counts)
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 8),
    ("access", "", r"AKIA[A-Z0-9]+", 16),
    ("hex", "", r"[0-9a-f]+", 32),
    ("github", "", r"gh[pousr]_[A-Za-z0-9]+", 40),
    ("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    ("jwt", "", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    ("key_block", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
)
BASE = ("assign", "access", "hex")
#: some text that holds a span of a kind matches this; most texts don't
ANY = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"""
       r"""|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-|eyJ[A-Za-z0-9_-]+\.|-----BEGIN""")
OPEN, SHUT, MID = "\x01", "\x02", "\x03"
SPAN = "array<struct<start:bigint,k:int,kind:string,end:bigint,secret:string>>"
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 3
LIVE_REPOS = 3
LIVE_CHARS = 6


def _spans_of(text: Column, k: int) -> Column:
    """Spans of kind ``k`` in a text without control characters."""
    kind, lead, value, least = KINDS[k]
    if kind == "hex":
        value = r"[0-9a-f]{32,}"  # maximal runs: the same spans, fewer matches
    marked = F.regexp_replace(text, F.lit(f"({lead})({value})"), F.lit(f"{OPEN}$1{MID}$2{SHUT}"))
    pieces = F.split(marked, f"[{OPEN}{SHUT}]", -1)  # gap, match, gap, match, ...

    def step(acc: Column, piece: Column) -> Column:
        lead_len = F.length(F.substring_index(piece, MID, 1)).cast("long")
        secret = F.substring_index(piece, MID, -1)
        is_match = acc["odd"]
        size = F.length(piece).cast("long") - is_match.cast("long")
        span = F.struct(acc["pos"].alias("start"), F.lit(k).alias("k"), F.lit(kind).alias("kind"),
                        (acc["pos"] + size).alias("end"), secret.alias("secret"))
        good = is_match & (F.length(secret) >= least) & (lead_len >= 0)
        return F.struct((acc["pos"] + size).alias("pos"), (~is_match).alias("odd"),
                        F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(False).alias("odd"),
                    F.array().cast(SPAN).alias("out"))
    return F.aggregate(pieces, zero, step, lambda acc: acc["out"])


def scan(docs: DataFrame, id_col="doc_id", text_col="text", owner_col="source", repo_cols=("source", "lang")) -> DataFrame:
    """``doc_id, owner, repo, spans`` (sorted by start, then kind)."""
    text = text_of(text_col)
    clean = F.translate(text, OPEN + SHUT + MID, "\x04\x04\x04")
    found = let(clean, lambda t: F.array_sort(F.concat(*[_spans_of(t, k) for k in range(len(KINDS))])))
    spans = F.when(text.rlike(ANY), found).otherwise(F.array().cast(SPAN))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                       F.to_json(F.struct(*repo_cols)).alias("repo"), spans.alias("spans"))


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, owner, repo`` rows -> per hash: ``n_seen, n_repos, n_owners``."""
    n = F.count(F.lit(1))
    return (candidates.groupBy("hash", "owner", "repo").agg(n.alias("n"))
            .groupBy("hash", "owner").agg(F.sum("n").alias("n"), n.alias("r"))
            .groupBy("hash").agg(F.sum("n").alias("n_seen"), F.sum("r").alias("n_repos"), n.alias("n_owners")))


def classify(scanned: DataFrame, example_owners: int = EXAMPLE_OWNERS, live_chars: int = LIVE_CHARS,
             example_repos: int = EXAMPLE_REPOS, live_repos: int = LIVE_REPOS) -> DataFrame:
    """Per document with spans (by ``rid``): secrets that look live (one owner, at
    most ``live_repos`` repositories, ``live_chars`` different characters), copied
    examples (at least ``example_owners`` and ``example_repos``), and the most owners
    and repositories of one of its secrets."""
    c = scanned.where(F.size("spans") > 0).select("rid", "owner", "repo", F.explode("spans").alias("s"))
    c = c.select("rid", "owner", "repo", F.sha2(F.col("s.secret"), 256).alias("hash"),
                 F.size(F.array_distinct(F.split(F.col("s.secret"), ""))).alias("chars"))
    owners = ownership(c)
    x = c.join(owners, "hash", "left")
    is_example = (F.col("n_owners") >= example_owners) & (F.col("n_repos") >= example_repos)
    is_live = (F.col("n_owners") == 1) & (F.col("n_repos") <= live_repos) & (F.col("chars") >= live_chars)
    return x.groupBy("rid").agg(F.count(F.when(is_live, 1)).alias("n_live"),
                                F.count(F.when(is_example, 1)).alias("n_example"),
                                F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"))


def report(docs: DataFrame, **scan_args) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all
    spans, and the ownership verdict."""
    s = staged(scan(docs, **scan_args).withColumn("rid", F.monotonically_increasing_id()), "secret-spans")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    rows = s.select("rid", "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                    F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
    none = F.lit(0).cast("long")
    plain = rows.where("spans = ''").select("*", none.alias("n_live"), none.alias("n_example"),
                                           none.alias("most_owners"), none.alias("most_repos"))
    hit = rows.where("spans <> ''").join(classify(s), "rid")
    return plain.unionByName(hit).drop("rid")


_FIND = {
    "assign": (r"((?:(?i:password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?)([A-Za-z0-9+/_.=-]+)"),
    "access": r"()(AKIA[A-Z0-9]+)", "hex": r"()([0-9a-f]{32,})", "github": r"()(gh[pousr]_[A-Za-z0-9]+)",
    "slack": r"()(xox[abprs]-[A-Za-z0-9-]+)", "jwt": r"()(eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)",
    "key_block": r"()(-----BEGIN [A-Z ]*PRIVATE KEY-----)",
}


def _sql() -> str:
    one = []
    for k, (kind, _, _, least) in enumerate(KINDS):
        one.append(
            f"SELECT rid, doc_id, source, lang, {k} AS k, '{kind}' AS kind, {least} AS least, string_split(replace("
            f"regexp_replace(t, '{_FIND[kind]}', chr(1) || '\\1' || chr(3) || '\\2' || chr(2), 'g'), chr(2), chr(1)), chr(1)) AS p FROM d")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang,
  translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), chr(4) || chr(4) || chr(4)) AS t FROM documents),
a AS ({' UNION ALL '.join(one)}),
b AS (SELECT * EXCLUDE (p), i, p[i] AS piece,
  length(replace(p[i], chr(3), '')) AS n FROM (SELECT *, unnest(range(1, length(p) + 1)) AS i FROM a)),
c AS (SELECT *, sum(n) OVER (PARTITION BY rid, k ORDER BY i) AS e FROM b),
s AS (SELECT *, string_split(piece, chr(3))[2] AS secret, e - n AS s FROM c
  WHERE i % 2 = 0 AND length(string_split(piece, chr(3))[2]) >= least),
own AS (SELECT secret, count(DISTINCT coalesce(source, chr(5))) AS owners,
  count(DISTINCT coalesce(source, chr(5)) || chr(6) || coalesce(lang, chr(5))) AS repos FROM s GROUP BY secret),
v AS (SELECT s.*, owners, repos, length(list_distinct(string_split(secret, ''))) AS chars FROM s JOIN own USING (secret)),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (owners = 1 AND repos <= {LIVE_REPOS} AND chars >= {LIVE_CHARS}) AS n_live,
  count(*) FILTER (owners >= {EXAMPLE_OWNERS} AND repos >= {EXAMPLE_REPOS}) AS n_example,
  max(owners) AS most_owners, max(repos) AS most_repos,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base FROM v GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_example, 0) AS n_example, coalesce(most_owners, 0) AS most_owners,
  coalesce(most_repos, 0) AS most_repos FROM d LEFT JOIN g USING (rid)"""


SQL = _sql()
