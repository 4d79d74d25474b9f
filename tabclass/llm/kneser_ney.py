"""Interpolated modified Kneser-Ney quality classifier.

A character n-gram model is trained on trusted texts; every document gets its
perplexity, and that of its worst passages: ``PASSAGE_SHARE`` of its runs of
``PASSAGE`` symbols (some 35 words) are not above it. Documents above a quantile
of their language's trusted held-out perplexities, in either, are rejected. The
n-grams span hardly more than a word, and a word repeated in a long run is
fluent to them on the whole; but over a passage a text averages many words and
the run only one.

An n-gram is packed into one long, 12 bits a symbol, so that context (shift)
and suffix (mask) are exact integer expressions and all counts, discounts and
interpolations are DataFrame joins on longs, sharded by key. A code point below
U+07C0 is one symbol; each other one is two, its upper and its lower ten bits,
from ranges of their own (U+0000 and U+0001 enter as U+0002):

* order 5 uses counts, lower orders the number of distinct left neighbours;
* D1, D2, D3+ per order come from the counts of counts;
* p(w|h) = max(c - D, 0) / c(h) + (D1 N1 + D2 N2 + D3 N3+) / c(h) * p(w|h').

Documents are written once as compressed blocks (see ``blocks``); the distinct
n-grams of each block are joined with the model, and their scores go back to
the block. Training reads the same blocks: only ids and block numbers are joined
with the trusted ids, and a block is told which of its rows to learn from, so
that no text is shuffled at any size.

The model is fitted on four fifths of all trusted documents, told apart by hash
of the id; the other fifth is held out for the thresholds. A caller may ask for fewer training
rows (``rows``); the registered queries do not. Nothing is
broadcast or collected by hand: the trusted ids are joined. Scores and verdicts
cover all documents.

Defined results: a null or empty text is one end symbol, and is rejected by
its own perplexity or kept like any other; a language's quantile (null is a
language) is drawn towards that of all languages, which counts as ``SHRINK``
held-out documents at every size, so a language without any uses it alone; no trusted
text at all keeps every document (perplexity of the uniform model); repeated
rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .blocks import from_blob, write_blocks
from .common import fresh, staged

ORDER = 5
BITS = 12
SYMBOLS = 1 << BITS
PAD, END = 0, 1
LOWER = SYMBOLS - 1024  # lower ten bits of a wide code point
UPPER = LOWER - (0x110000 >> 10)  # its upper bits; smaller code points are symbols
QUANTILE = 0.99
SLACK = 1.02
SHRINK = 50  # held-out documents that the quantile of all languages counts as, beside a language's own
PASSAGE = 200
PASSAGE_SHARE = 0.98


# ------------------------------------------------------------------ n-grams
def symbols(texts: list[str]) -> np.ndarray:
    """Symbols of all texts: ORDER-1 pads before each text, one end after it."""
    clean = [t.translate({0: 2, 1: 2}) if "\x00" in t or "\x01" in t else t for t in texts]
    pads = "\x00" * (ORDER - 1)
    big = pads + ("\x01" + pads).join(clean) + "\x01"
    x = np.frombuffer(big.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    wide = x >= UPPER
    if wide.any():
        size = 1 + wide
        second = (np.cumsum(size) - 1)[wide]
        code, x = x[wide], np.repeat(x, size)
        x[second - 1], x[second] = UPPER + (code >> 10), LOWER + (code & 1023)
    return x


def grams(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends there, is a text's last) for every symbol but the pads."""
    n = len(x) - (ORDER - 1)
    g = np.zeros(n, dtype=np.int64)
    for k in range(ORDER):
        g = (g << BITS) | x[k:k + n]
    last = x[ORDER - 1:]
    real = last != PAD
    return g[real], last[real] == END


def texts_of(batch, at: int) -> list[str]:
    return [t or "" for t in batch.column(at).to_pylist()]


class Counter:
    """Counts of the n-grams of texts, held up to a bounded number of distinct ones."""

    def __init__(self):
        self.held, self.size = [], 0

    def merge(self) -> None:
        g = np.concatenate([a for a, _ in self.held])
        c = np.concatenate([b for _, b in self.held])
        u, inv = np.unique(g, return_inverse=True)
        self.held, self.size = [(u, np.bincount(inv, weights=c).astype(np.int64))], len(u)

    def add(self, texts: list[str]):
        """Counts the texts; gives the table whenever it has outgrown its bound."""
        for k in range(0, len(texts), 256):
            u, c = np.unique(grams(symbols(texts[k:k + 256]))[0], return_counts=True)
            self.held.append((u, c))
            self.size += len(u)
            if self.size > 2_000_000:
                self.merge()
                if self.size > 1_000_000:
                    yield from self.rest()

    def rest(self):
        if self.held:
            self.merge()
            (u, c), = self.held
            self.held, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c)], ["g", "c"])


def summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("g").agg(F.sum("c").alias("c"))


def count_grams(texts: DataFrame) -> DataFrame:
    """``g, c`` over one column of texts: combined in each task, then by key."""
    def run(batches):
        counter = Counter()
        for b in batches:
            yield from counter.add(texts_of(b, 0))
        yield from counter.rest()

    return summed(texts.mapInArrow(run, "g long, c long"))


# -------------------------------------------------------------------- model
def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, start=1)]


class Model:
    """Counts and contexts of every order, staged in the shared folder."""

    def __init__(self, counts: DataFrame):
        self.grams, self.contexts, self.d = {}, {}, {}
        g = staged(counts, f"kn-{ORDER}")
        for k in range(ORDER, 0, -1):
            if k < ORDER:  # continuation counts: distinct left neighbours
                cut = F.col("g").bitwiseAND(F.lit((1 << (BITS * k)) - 1))
                g = staged(g.groupBy(cut.alias("g")).agg(F.count(F.lit(1)).alias("c")), f"kn-{k}")
            self.grams[k] = g
            seen = [F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)]
            self.d[k] = discounts(list(g.agg(*seen).first()))
            few = [F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2)]
            ctx = g.groupBy(F.shiftright("g", BITS).alias("h")).agg(
                F.sum("c").alias("total"), *few, F.count(F.when(F.col("c") > 2, 1)).alias("n3"))
            d1, d2, d3 = self.d[k]
            weight = (F.col("n1") * d1 + F.col("n2") * d2 + F.col("n3") * d3) / F.col("total")
            self.contexts[k] = ctx.select("h", "total", weight.alias("gamma"))

    def score(self, wanted: DataFrame) -> DataFrame:
        """``g, lp`` (log10 probability of the last symbol) for the distinct
        n-grams ``g`` of full order."""
        cut = lambda k: F.col("g").bitwiseAND(F.lit((1 << (BITS * k)) - 1))
        lower, p = None, None
        for k in range(1, ORDER + 1):
            q = wanted.select(cut(k).alias("g")).distinct() if k < ORDER else wanted.select("g")
            d1, d2, d3 = self.d[k]
            q = q.join(self.grams[k], "g", "left")
            if k == 1:  # one context: the empty one
                top = self.contexts[1].first()
                total, gamma = F.lit(float(top["total"]) if top else None), F.lit(float(top["gamma"]) if top else None)
                q = q.select("g", "c", total.cast("double").alias("total"), gamma.cast("double").alias("gamma"))
                low = F.lit(1.0 / SYMBOLS)
            else:
                q = (q.withColumn("h", F.shiftright("g", BITS)).withColumn("s", cut(k - 1))
                     .join(self.contexts[k], "h", "left").join(lower, "s"))
                low = F.col("low")
            c = F.coalesce(F.col("c"), F.lit(0))
            d = F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3)
            p = F.when(F.col("total").isNull(), low).otherwise((c - d) / F.col("total") + F.col("gamma") * low)
            lower = q.select(F.col("g").alias("s"), p.alias("low"))
        return lower.select(F.col("s").alias("g"), F.log10("low").alias("lp"))


# ------------------------------------------------------------------ scoring
class Lookup:
    """log10 probabilities by n-gram: a table addressed by hash, and a binary
    search for what it misses."""

    def __init__(self, g: np.ndarray, lp: np.ndarray | None):
        order = np.argsort(g)
        self.g, self.lp = g[order], None if lp is None else lp[order]
        self.bits = max(8, int(np.ceil(np.log2(len(g) + 1))) + 3)
        self.table = np.zeros(1 << self.bits, dtype=np.int32)
        self.table[self.slot(self.g)] = np.arange(len(g), dtype=np.int32)

    def slot(self, g):
        return ((g.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def holds(self, g: np.ndarray) -> np.ndarray:
        """Whether the table has it; of those that share a slot it has one."""
        return self.g[self.table[self.slot(g)]] == g if len(self.g) else np.zeros(len(g), dtype=bool)

    def __call__(self, g: np.ndarray) -> np.ndarray:
        at = self.table[self.slot(g)]
        miss = np.flatnonzero(self.g[at] != g)
        if len(miss):
            again = np.minimum(np.searchsorted(self.g, g[miss]), len(self.g) - 1)
            if (self.g[again] != g[miss]).any():
                raise ValueError("an n-gram of the block has no score")
            at[miss] = again
        return self.lp[at]


def trusted_ids(labels: DataFrame, id_col: str, good, rows: int | None = None) -> DataFrame:
    """``trusted_id, held_out`` of all trusted documents: four fifths, told apart by
    hash, are for training. With ``rows`` that many are picked by hash before,
    and all others are held out too."""
    h = F.xxhash64(F.col(id_col), F.lit(9))
    t = labels.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).alias("trusted_id"), h.alias("h"))
    t = staged(t.groupBy("trusted_id").agg(F.first("h").alias("h")), "kn-trusted")
    held = F.pmod("h", F.lit(5)) == 0
    if rows is not None:
        last = t.orderBy("h", "trusted_id").limit(rows).agg(F.max(F.struct("h", "trusted_id")).alias("m")).first().m
        picked = F.lit(False) if last is None else F.struct("h", "trusted_id") <= F.struct(
            F.lit(last.h), F.lit(last.trusted_id).cast(t.schema["trusted_id"].dataType))
        held = ~picked | held
    return t.select("trusted_id", held.alias("held_out"))


def written(docs: DataFrame, text_col="text") -> str:
    """The table of blocks of ``docs`` with their distinct n-grams."""
    at = docs.columns.index(text_col)
    return write_blocks(docs, text_col, lambda: Seen(at), "bigint", "kn_blocks")


def count_trusted(docs: DataFrame, table: str, train: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``g, c`` over the texts of ``docs``, written as ``table``, whose id is a ``trusted_id`` of ``train``.
    Ids and block numbers are joined, and the blocks, which are where they are needed, get theirs."""
    at, key = docs.columns.index(text_col), docs.columns.index(docs.select(id_col).columns[0])
    blocks = docs.sparkSession.table(table).select("block", "blob")

    def ids(batches):
        for b in batches:
            for block, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = from_blob(blob).column(key).drop_null()
                yield pa.RecordBatch.from_arrays([own, pa.array([block] * len(own), pa.int64())], ["id", "block"])

    def count(left, right):
        counter, out = Counter(), []
        for blob in left.column("blob").to_pylist() if right.num_rows else ():
            batch = from_blob(blob)
            own = batch.column(key)
            batch = batch.filter(pc.is_in(own, value_set=right.column("id").cast(own.type), skip_nulls=True))
            out += counter.add(texts_of(batch, at))
        return pa.Table.from_batches([*out, *counter.rest()], pa.schema([("g", pa.int64()), ("c", pa.int64())]))

    kind = StructType().add("id", docs.schema.fields[key].dataType).add("block", "long")
    wanted = blocks.mapInArrow(ids, kind)
    wanted = wanted.join(train, wanted["id"] == train["trusted_id"], "left_semi")
    return summed(blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(count, "g long, c long"))


def fit(docs: DataFrame, trusted: DataFrame, id_col="doc_id", text_col="text", table: str | None = None) -> Model:
    """The model of the documents for training; ``table`` are the blocks of ``docs``, if they are written."""
    train = trusted.where("not held_out").select("trusted_id")
    own = table or written(docs, text_col)
    model = Model(count_trusted(docs, own, train, id_col, text_col))
    if table is None:
        docs.sparkSession.sql(f"DROP TABLE {own}")
    return model


def worst_passage(cost: np.ndarray) -> float:
    """What ``PASSAGE_SHARE`` of the passages' mean costs are not above; a
    shorter text is one passage."""
    n = len(cost) - PASSAGE + 1
    if n <= 1:
        return float(cost.mean())
    upto = np.concatenate([[0.0], np.cumsum(cost)])
    k = int(np.ceil(PASSAGE_SHARE * n)) - 1
    return float(np.partition(upto[PASSAGE:] - upto[:n], k)[k] / PASSAGE)


class Seen:
    """Distinct n-grams of a block. What the table of known ones holds is passed
    over; the rest is sorted, and the table made anew when it has grown."""

    def __init__(self, at: int):
        self.at, self.look, self.more, self.n = at, None, [], 0

    def add(self, batch) -> None:
        g = grams(symbols(texts_of(batch, self.at)))[0]
        if self.look is not None:
            g = g[~self.look.holds(g)]
        u = np.unique(g)
        self.more.append(u)
        self.n += len(u)
        if self.look is None or self.n > len(self.look.g) // 8:
            self.look = Lookup(self.all(), None)
            self.more, self.n = [], 0

    def all(self) -> np.ndarray:
        return np.unique(np.concatenate([*self.more, *([] if self.look is None else [self.look.g])]))

    def get(self) -> pa.Array:
        return pa.array(self.all())


def perplexity(docs: DataFrame, model: Model, text_col="text", carry: list[str] | None = None,
               table: str | None = None) -> DataFrame:
    """The columns ``carry`` (all) of ``docs``, then ``log_ppl`` (log10),
    ``n_symbols`` and ``log_passage`` (``log_ppl`` of the worst passages).
    ``table`` are the blocks of ``docs``, if they are written; it is dropped."""
    log_ppl, n_sym, log_passage = fresh(docs, "log_ppl", "n_symbols", "log_passage")
    carry = carry or docs.columns
    at, keep = docs.columns.index(text_col), [docs.columns.index(c) for c in carry]
    spark = docs.sparkSession
    table = table or written(docs, text_col)
    blocks = spark.table(table)
    pairs = blocks.where("items is not null").select("block", F.explode("items").alias("g"))
    scores = staged(model.score(staged(pairs.select("g").distinct(), "kn-wanted")), "kn-scores")

    def bundle(batches):
        """(block, n-gram, score) rows as one row per block and task."""
        t = pa.Table.from_batches(batches)
        block = t.column("block").to_numpy()
        g, lp = t.column("g").to_numpy(), t.column("lp").to_numpy().astype("<f4")
        order = np.lexsort((g, block))
        cuts = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            k = order[a:b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[k[:1]]), pa.array([g[k].tobytes()]), pa.array([lp[k].tobytes()])], ["block", "g", "lp"])

    bundles = pairs.join(scores.hint("merge"), "g").select("block", "g", "lp").mapInArrow(
        lambda it: (x for some in slices(it) for x in bundle(some)), "block long, g binary, lp binary")

    def score(left, right):
        look = Lookup(np.frombuffer(b"".join(right.column("g").to_pylist()), dtype="<i8"),
                      np.frombuffer(b"".join(right.column("lp").to_pylist()), dtype="<f4").astype(float))
        for blob in left.column("blob").to_pylist():
            batch = from_blob(blob)
            g, last = grams(symbols(texts_of(batch, at)))
            ends = np.flatnonzero(last)
            starts = np.concatenate([[0], ends[:-1] + 1])
            size = ends - starts + 1
            cost = -look(g)
            ppl = np.add.reduceat(cost, starts) / size
            passage = [worst_passage(cost[a:b + 1]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(ppl), pa.array(size),
                                              pa.array(passage, pa.float64())], out_names)

    out_names = [*carry, log_ppl, n_sym, log_passage]
    schema = StructType([docs.schema.fields[i] for i in keep]).add(log_ppl, "double").add(n_sym, "long").add(
        log_passage, "double")
    scored = blocks.select("block", "blob").groupBy("block").cogroup(bundles.groupBy("block")).applyInArrow(
        lambda left, right: pa.Table.from_batches(list(score(left, right))), schema)
    scored = staged(scored, "kn-scored")
    spark.sql(f"DROP TABLE {table}")
    return scored


def slices(batches, rows: int = 1_000_000):
    """Lists of batches with about ``rows`` rows together."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield held
            held, n = [], 0
    if n:
        yield held


def thresholds(scored: DataFrame, trusted: DataFrame, id_col: str, lang_col: str, log_ppl: str,
               quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """``lang, limit, n`` from the ``n`` held-out trusted documents; the row of
    all languages has ``pooled``. Quantiles are taken over bins of 0.0001."""
    held = trusted.where("held_out").select("trusted_id")
    x = scored.join(held, F.col(id_col) == held.trusted_id).select(
        F.col(lang_col).alias("lang"), F.floor(F.col(log_ppl) * 10000).alias("bin"))
    bins = x.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    bins = bins.select("lang", F.lit(False).alias("pooled"), "bin", "n").unionAll(
        bins.groupBy("bin").agg(F.sum("n").alias("n")).select(
            F.lit(None).cast("string").alias("lang"), F.lit(True).alias("pooled"), "bin", "n"))
    w = Window.partitionBy("pooled", "lang")
    upto = F.sum("n").over(w.orderBy("bin"))
    total = F.sum("n").over(w)
    cum = bins.select("lang", "pooled", "bin", upto.alias("upto"), total.alias("total"))
    at = F.min(F.when(F.col("upto") >= F.col("total") * quantile, F.col("bin")))
    lim = cum.groupBy("pooled", "lang").agg(((at + 1) / 10000.0 * slack).alias("limit"), F.max("total").alias("n"))
    return lim.select("lang", "pooled", "limit", "n")


def drawn(limit, n, pooled):
    """A language's quantile of ``n`` held-out documents, drawn towards that of
    all languages: the same rule at every ``n``, and the pooled one at none."""
    return (n * limit + SHRINK * pooled) / (n + SHRINK)


def classify(docs: DataFrame, labels: DataFrame, good, id_col="doc_id", text_col="text", lang_col="lang",
             label_id="doc_id", rows: int | None = None, quantile: float = QUANTILE,
             carry: list[str] | None = None) -> tuple[DataFrame, str, str, str]:
    """The columns ``carry`` (all) of ``docs`` with perplexity, threshold and
    verdict, and the names of these three; also ``log_passage`` and its threshold
    ``passage_limit``, which the verdict includes."""
    trusted = trusted_ids(labels, label_id, good, rows)
    table = written(docs, text_col)
    model = fit(docs, trusted, id_col, text_col, table)
    log_ppl, _, log_passage = fresh(docs, "log_ppl", "n_symbols", "log_passage")
    scored = perplexity(docs, model, text_col, carry, table)
    limit, kept, key, passage_limit = fresh(scored, "limit", "kept", "limit_lang", "passage_limit")
    out, good_enough = scored, F.lit(True)
    for value, bound in ((log_ppl, limit), (log_passage, passage_limit)):
        lim = staged(thresholds(scored, trusted, id_col, lang_col, value, quantile), "kn-limits")
        pooled = lim.where("pooled").first()
        top = F.lit(pooled["limit"] if pooled else None).cast("double")
        own = lim.where("not pooled").select(F.col("lang").alias(key), drawn(F.col("limit"), F.col("n"), top).alias(bound))
        out = out.join(own, out[lang_col].eqNullSafe(own[key]), "left").drop(key)
        out = out.withColumn(bound, F.coalesce(F.col(bound), top))
        good_enough &= F.coalesce(F.col(value) <= F.col(bound), F.lit(True))
    return out.withColumn(kept, good_enough), log_ppl, limit, kept


def keep_good(docs: DataFrame, labels: DataFrame, good, **args) -> DataFrame:
    """The documents that the classifier keeps, same columns."""
    out, _, _, kept = classify(docs, labels, good, **args)
    return out.where(F.col(kept)).select(*docs.columns)
