"""Subword lattice likelihood.

The pieces of an existing public subword vocabulary, with a log probability
each, span a lattice over every word; the probability of a word is the sum over
all its segmentations, computed by the forward recursion in log space, and the
probability of a text is the product over its words and its end.

    P(end)  = (texts + 1) / (N + 2)                              N: training tokens
    P(word) = (1 - P(end)) * L(word)

Start pieces (with the word mark) and inner pieces together have probability 1,
so L is a distribution over words, and P one over texts.

The vocabulary's own scores start the pieces off (a BPE vocabulary scores by
rank; rank r gets weight 1 / (r + 3)), and ``rounds`` rounds of forward-backward
over the training words, each as often as it occurs, update them; the prior
counts as ``PRIOR`` uses, so every piece keeps a probability. The arcs of the
distinct words are searched once and written as packed columns; the rounds and
the scoring are array operations on them. The vocabulary is read on the driver
and sent along (its size is the bound); word counts are grouped and joined by
word, and reach the texts as compressed blocks (see ``blocks``).

``word_score`` stands beside the score for comparison: a training word is one
more arc over the whole word, max(c - D, 0) / W (W words, c the word's count,
Ney's D = n1 / (n1 + 2 n2)), and the mass D V / W that this frees (V distinct
words) goes to L.

Words are runs of anything but ASCII white space, A-Z in lower case; a
character without a piece is spelt by its byte pieces.

Defined results: a null or wordless text is its end alone; repeated rows are
scored alike and each trains; without training words the prior is used, and
``word_score`` is the score; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from ..session import scratch_path
from .blocks import from_blob, write_blocks
from .common import staged

MARK = "▁"
ROUNDS = 3
PRIOR = 1000.0  # uses that the vocabulary's own weights stand for
BATCH = 4096
CHARS = 1 << 16  # of a batch's words together: what a lattice, or a row of arcs, holds
LONG = 64  # longer words go through the lattice in batches of their own
ROW_GROUP = 16 << 20  # of the table of arcs: a reader holds a row group


def read_vocabulary(path: str):
    """((ids by piece, ids by byte value, prefixes of pieces), prior log
    probabilities), plain data that can be broadcast."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, of_byte, rank = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            of_byte[int(p[3:5], 16)] = len(rank)
        elif sp.is_control(i) or sp.is_unknown(i) or MARK in p[1:]:
            continue
        else:
            ids[p] = len(rank)
        rank.append(-sp.get_score(i) if not sp.is_byte(i) else float(sp.get_piece_size()))
    weight = 1.0 / (np.maximum(np.array(rank), 0.0) + 3.0)
    # with every prefix of a piece a search can end where no piece goes on
    return (ids, of_byte, {p[:k] for p in ids for k in range(1, len(p))}), np.log(weight / weight.sum())


class Lattice:
    """The arcs of a batch of words, in the order of word, start and end, as plain
    arrays: characters of each word with its mark (``size``), arcs from each
    place (``n``), length and piece of each arc; a spelt character has piece -1,
    its byte pieces follow in ``spelt``, ``n_spelt`` for each."""

    FIELDS = {"size": np.int32, "n": np.uint8, "length": np.uint8, "piece": np.int32, "n_spelt": np.uint8,
              "spelt": np.int32}

    def __init__(self, **arrays):
        self.__dict__.update(arrays)
        self.first = np.cumsum(self.size + 1, dtype=np.int64) - self.size - 1  # nodes of all words in one row
        places = np.arange(len(self.n)) - np.repeat(self.first - np.arange(len(self.size)), self.size)
        s = np.repeat(places, self.n)
        self.word = np.repeat(np.repeat(np.arange(len(self.size)), self.size), self.n)
        self.a = self.first[self.word] + s
        self.b = self.a + self.length
        self.start, self.end = s, s + self.length
        self.own = np.flatnonzero(self.piece < 0)

    @classmethod
    def of(cls, words: list[str], vocab) -> Lattice:
        ids, of_byte, prefixes = vocab
        n, length, piece, n_spelt, spelt = [], [], [], [], []
        find = ids.get
        for word in words:
            t = MARK + word
            stop = len(t)
            for i in range(stop):
                held, alone = len(piece), False
                for j in range(i + 1, stop + 1):
                    x = t[i:j]
                    k = find(x)
                    if k is not None:
                        length.append(j - i)
                        piece.append(k)
                        alone = alone or j == i + 1
                    if x not in prefixes:
                        break
                if not alone:
                    of = [of_byte[c] for c in t[i].encode("utf-8", "surrogatepass")]
                    length.append(1)
                    piece.append(-1)
                    n_spelt.append(len(of))
                    spelt += of
                n.append(len(piece) - held)
        size = [len(w) + 1 for w in words]
        of = dict(size=size, n=n, length=length, piece=piece, n_spelt=n_spelt, spelt=spelt)
        return cls(**{k: np.array(of[k], dtype=t) for k, t in cls.FIELDS.items()})

    def pack(self) -> list[bytes]:
        return [getattr(self, k).tobytes() for k in self.FIELDS]

    @classmethod
    def unpack(cls, fields) -> Lattice:
        return cls(**{k: np.frombuffer(x, dtype=t) for (k, t), x in zip(cls.FIELDS.items(), fields, strict=True)})

    def forward(self, log_p: np.ndarray, expected: np.ndarray | None = None, weight=None) -> np.ndarray:
        """Log of the sum over all segmentations, for each word. With ``expected``,
        the expected uses of each piece, a word counting as ``weight`` (1) words,
        are added to it (forward-backward)."""
        lp = log_p[self.piece]
        if len(self.own):
            at = np.cumsum(self.n_spelt, dtype=np.int64) - self.n_spelt
            lp[self.own] = np.add.reduceat(log_p[self.spelt], at)
        last = self.first + self.size
        alpha = np.full(int(last[-1]) + 1, -np.inf)
        alpha[self.first] = 0.0
        _sweep(alpha, self.end, self.a, self.b, lp)
        total = alpha[last]
        if expected is not None:
            beta = np.full(len(alpha), -np.inf)
            beta[last] = 0.0
            _sweep(beta, self.start.max() - self.start, self.b, self.a, lp)
            use = np.exp(alpha[self.a] + lp + beta[self.b] - total[self.word])
            if weight is not None:
                use *= weight[self.word]
            plain = self.piece >= 0
            expected += np.bincount(self.piece[plain], weights=use[plain], minlength=len(expected))
            expected += np.bincount(self.spelt, weights=np.repeat(use[self.own], self.n_spelt), minlength=len(expected))
        return total


def _sweep(value: np.ndarray, level: np.ndarray, source: np.ndarray, target: np.ndarray, lp: np.ndarray) -> None:
    """Fills ``value`` level by level: of each target, the log of the sum over
    its arcs. Arcs to one target are neighbours in their level."""
    order = np.argsort(level.astype(np.int16 if level.max() < 1 << 15 else np.int64), kind="stable")
    source, target, lp = source[order], target[order], lp[order]
    level = level[order]
    cuts = [0, *(np.flatnonzero(np.diff(level)) + 1), len(level)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        to, v = target[lo:hi], value[source[lo:hi]] + lp[lo:hi]
        at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        top = np.maximum.reduceat(v, at)
        size = np.diff(np.append(at, hi - lo))
        value[to[at]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, size)), at))


def batches_of(words: list[str]):
    """Places of the words in batches of like length, at most ``BATCH`` words or
    ``CHARS`` characters each; a longer word is one alone."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    upto = np.cumsum([0, *(len(words[i]) + 1 for i in order)])
    start = 0
    while start < len(order):
        most = int(np.searchsorted(upto, upto[start] + CHARS, side="right")) - 1
        stop = min(start + BATCH, max(most, start + 1), len(order))
        while stop - start > 1 and len(words[order[stop - 1]]) > max(LONG, 2 * len(words[order[start]])):
            stop = start + (stop - start) // 2
        yield order[start:stop]
        start = stop


def forward(words: list[str], vocab, log_p: np.ndarray, expected: np.ndarray | None = None) -> np.ndarray:
    """Log of the sum over all segmentations of plain words, see ``Lattice``."""
    out = np.empty(len(words))
    for pick in batches_of(words):
        out[pick] = Lattice.of([words[i] for i in pick], vocab).forward(log_p, expected)
    return out


ARCS = "seen boolean, word array<binary>, c array<bigint>, " + ", ".join(f"`{k}` binary" for k in Lattice.FIELDS)


def write_arcs(counts: DataFrame, vocab) -> DataFrame:
    """A row for each batch of distinct words (``word, c``): the words, their
    counts, and their arcs; ``seen`` tells training words from all others."""
    v = counts.sparkSession.sparkContext.broadcast(vocab)  # bounded by the vocabulary
    schema = to_arrow_schema(StructType.fromDDL(ARCS))

    def run(batches):
        vocab = v.value
        for b in batches:
            words, c = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            for seen in (True, False):
                of = np.flatnonzero((c > 0) == seen)
                texts = [words[i].decode("utf-8", "surrogatepass") for i in of]
                for pick in batches_of(texts):
                    at = of[pick]
                    fields = Lattice.of([texts[i] for i in pick], vocab).pack()
                    row = [seen, [words[i] for i in at], c[at].tolist(), *fields]
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)],
                                                     schema=schema)

    path = scratch_path(counts.sparkSession, "lattice-arcs")
    (counts.select("word", "c").mapInArrow(run, ARCS).write
     .options(**{"compression": "zstd", "parquet.block.size": ROW_GROUP, "parquet.page.size.row.check.min": 4}).parquet(path))
    return counts.sparkSession.read.schema(ARCS).parquet(path)


def estimate(arcs: DataFrame, prior: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces, from the training words' arcs."""
    log_p = prior
    for _ in range(rounds):
        v = arcs.sparkSession.sparkContext.broadcast(log_p)  # one number per piece

        def run(batches, v=v):
            log_p = v.value
            expected = np.zeros(len(log_p))
            for b in batches:
                for i in range(b.num_rows):
                    c, *fields = (b.column(k)[i].as_py() for k in range(b.num_columns))
                    Lattice.unpack(fields).forward(log_p, expected, np.array(c, dtype=float))
            at = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(expected[at])], ["piece", "uses"])

        uses = arcs.where("seen").select("c", *Lattice.FIELDS).mapInArrow(run, "piece long, uses double")
        got = uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # one row per piece
        weight = PRIOR * np.exp(prior)
        for r in got:
            weight[r["piece"]] += r["uses"]
        log_p = np.log(weight / weight.sum())
    return log_p


class Words:
    """Distinct words of a block with their count in training texts."""

    def __init__(self, flag: str, text: str):
        self.flag, self.text, self.count = flag, text, {}

    def add(self, batch) -> None:
        count = self.count
        texts = batch.column(batch.schema.get_field_index(self.text)).cast(pa.binary()).to_pylist()
        flags = batch.column(batch.schema.get_field_index(self.flag)).to_pylist()
        for t, train in zip(texts, flags, strict=True):
            for w in (t or b"").lower().split():
                count[w] = count.get(w, 0) + train

    def get(self) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(list(self.count), pa.binary()),
                                           pa.array(list(self.count.values()), pa.int64())], ["word", "c"])


def score(docs: DataFrame, train: Column, vocabulary: str, id_col="doc_id", text_col="text",
          rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, train, n_tokens, n_known, train_tokens, base_score, score,
    word_score`` for each document; ``train`` tells which documents the model learns from.
    ``base_score`` is the add-one unigram log10 probability of the same tokens."""
    spark = docs.sparkSession
    vocab, prior = read_vocabulary(vocabulary)
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(True)).cast("int").alias("train"),
                    F.col(text_col).cast("string").alias("text"))
    table = write_blocks(d, "text", lambda: Words("train", "text"), "struct<word:binary,c:bigint>", "lattice_blocks")
    blocks = spark.table(table)
    pairs = blocks.where("items is not null").select("block", F.inline("items"))
    counts = staged(pairs.groupBy("word").agg(F.sum("c").alias("c")), "lattice-counts")
    seen = F.col("c") > 0
    s = counts.agg(F.sum("c"), F.count(F.when(seen, 1)), F.count(F.when(F.col("c") == 1, 1)),
                   F.count(F.when(F.col("c") == 2, 1))).first()
    n_words, n_types, n1, n2 = (int(x or 0) for x in s)
    ends = d.where("train = 1").count()
    n_all, v_all = n_words + ends, n_types + (1 if ends else 0)
    disc = n1 / (n1 + 2 * n2) if n1 else 0.75
    p_end = (ends + 1) / (n_all + 2)
    arcs = write_arcs(counts, vocab)
    log_p = estimate(arcs, prior, rounds)

    def weigh(batches):
        for b in batches:
            for i in range(b.num_rows):
                words, c, *fields = (b.column(k)[i] for k in range(b.num_columns))
                lat = Lattice.unpack([x.as_py() for x in fields]).forward(log_p)
                count, mixed = c.values.to_numpy().astype(float), lat
                if n_words:  # log of the mixture, without leaving log space
                    with np.errstate(divide="ignore"):
                        whole = np.log(np.maximum(count - disc, 0.0) / n_words)
                    mixed = np.logaddexp(whole, lat + math.log(disc * n_types / n_words))
                lp, word_lp = ((x + math.log1p(-p_end)) / math.log(10) for x in (lat, mixed))
                yield pa.RecordBatch.from_arrays([words.values, c.values, pa.array(lp), pa.array(word_lp)],
                                                 ["word", "c", "lp", "word_lp"])

    weighed = staged(arcs.select("word", "c", *Lattice.FIELDS)
                     .mapInArrow(weigh, "word binary, c long, lp double, word_lp double"), "lattice-words")
    back = pairs.select("block", "word").join(weighed.hint("merge"), "word").select(
        F.col("block").alias("of_block"), "word", "c", "lp", "word_lp")
    floor = n_all + v_all + 1
    end_base = math.log10((ends + 1) / floor)

    def score_block(left, right):
        words = right.column("word").to_pylist()
        c = right.column("c").to_numpy()
        lp = right.column("lp").to_numpy()
        word_lp = right.column("word_lp").to_numpy()
        base = np.log10((c + 1) / floor)
        index = {w: i for i, w in enumerate(words)}
        cols: list[list] = [[], [], [], [], [], [], []]
        for blob in left.column("blob").to_pylist():
            rows = from_blob(blob)
            cols[0] += rows.column("doc_id").to_pylist()
            cols[1] += rows.column("train").to_pylist()
            for t in rows.column("text").cast(pa.binary()).to_pylist():
                at = np.fromiter(map(index.__getitem__, (t or b"").lower().split()), dtype=np.int64)
                cols[2].append(len(at) + 1)
                cols[3].append(int((c[at] > 0).sum()) + (ends > 0))
                cols[4].append(float(base[at].sum()) + end_base)
                cols[5].append(float(lp[at].sum()) + math.log10(p_end))
                cols[6].append(float(word_lp[at].sum()) + math.log10(p_end))
        return pa.table([pa.array(x, f.type) for x, f in zip(cols, out, strict=True)], schema=out)

    id_type = d.schema["doc_id"].dataType

    out = pa.schema([("doc_id", to_arrow_type(id_type)), ("train", pa.int32()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("word_score", pa.float64())])
    ddl = (f"doc_id {id_type.simpleString()}, train int, n_tokens long, n_known long, base_score double, "
           "score double, word_score double")
    scored = blocks.select("block", "blob").groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(score_block, ddl)
    scored = staged(scored, "lattice-scores")
    spark.sql(f"DROP TABLE {table}")
    return scored.select("doc_id", (F.col("train") == 1).alias("train"), "n_tokens", "n_known",
                         F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score",
                         "word_score")
