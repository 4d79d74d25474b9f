"""Subword lattice and Kneser-Ney: against enumeration and a dictionary model."""

import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tabclass.llm import kneser_ney as kn
from tabclass.llm import lattice
from tests.conftest import SF_TINY
from tests.llm.conftest import ROWS

VOCAB = public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ lattice
@pytest.fixture(scope="module")
def vocab():
    return lattice.read_vocabulary(VOCAB)


def enumerate_segmentations(t, at, vocab, log_p):
    """Sum over all segmentations of t[at:], by recursion over pieces."""
    ids, of_byte, _ = vocab
    if at == len(t):
        return 1.0
    total = 0.0
    for j in range(at + 1, len(t) + 1):
        if t[at:j] in ids:
            total += math.exp(log_p[ids[t[at:j]]]) * enumerate_segmentations(t, j, vocab, log_p)
    if t[at] not in ids:
        spelt = math.exp(sum(log_p[of_byte[b]] for b in t[at].encode()))
        total += spelt * enumerate_segmentations(t, at + 1, vocab, log_p)
    return total


def test_forward_sums_all_segmentations(vocab):
    pieces, log_p = vocab
    words = ["the", "a", "international", "ñandú", "x1y2", "日本", "😀ok", "q" * 12]
    got = lattice.forward(words, pieces, log_p)
    want = [math.log(enumerate_segmentations(lattice.MARK + w, 0, pieces, log_p)) for w in words]
    assert got == pytest.approx(want)


def test_long_words_and_batches(vocab):
    pieces, log_p = vocab
    words = ["a", "ab" * 3000, "the", "x" * 500] * 3
    one = [float(lattice.forward([w], pieces, log_p)[0]) for w in words]
    assert lattice.forward(words, pieces, log_p) == pytest.approx(one)
    assert all(np.isfinite(one))


def test_expected_uses_spell_the_words(vocab):
    pieces, log_p = vocab
    uses = np.zeros(len(log_p))
    lattice.forward(["hello", "日"], pieces, log_p, uses)
    text = {k: p for p, k in pieces[0].items()}
    chars = sum(u * len(text[k]) for k, u in enumerate(uses) if k in text)
    spelt = sum(u for k, u in enumerate(uses) if k not in text)
    assert chars + spelt / 3 == pytest.approx(len("▁hello") + len("▁日"))


def base_scores(rows):
    count, tokens = Counter(), []
    for i, t, train in rows:
        w = (t or "").encode().lower().split() + ["end"]
        tokens.append((i, w))
        if train:
            count.update(w)
    n, v = sum(count.values()), len(count)
    return n, [(i, len(w), sum(count[x] > 0 for x in w), sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
               for i, w in tokens]


def whole_scores(rows, pieces, log_p, rounds):
    """The whole score column by enumeration: forward-backward as expected uses
    over all segmentations, weights updated, then the marginal of each text."""
    ids, of_byte, _ = pieces
    tokens = [(i, [w.decode() for w in (t or "").encode().lower().split()], train) for i, t, train in rows]
    count = Counter(w for _, ws, train in tokens if train for w in ws)
    prior = log_p

    def segmentations(t, at=0):
        if at == len(t):
            yield ()
            return
        starts = [(j, (ids[t[at:j]],)) for j in range(at + 1, len(t) + 1) if t[at:j] in ids]
        if t[at] not in ids:
            starts.append((at + 1, tuple(of_byte[b] for b in t[at].encode())))
        for j, used in starts:
            for rest in segmentations(t, j):
                yield used + rest

    def marginal(w, log_p):
        return sum(math.exp(sum(log_p[k] for k in s)) for s in segmentations(lattice.MARK + w))

    for _ in range(rounds):
        weight = lattice.PRIOR * np.exp(prior)
        for w, c in count.items():
            total = marginal(w, log_p)
            for s in segmentations(lattice.MARK + w):
                for k in s:
                    weight[k] += c * math.exp(sum(log_p[k] for k in s)) / total
        log_p = np.log(weight / weight.sum())
    ends, n = sum(train for *_, train in tokens), sum(count.values())
    p_end = (ends + 1) / (n + ends + 2)
    return [(i, math.log10(p_end) + sum(math.log10((1 - p_end) * marginal(w, log_p)) for w in ws)) for i, ws, _ in tokens]


@pytest.mark.parametrize("rounds", [0, 2])
def test_scores_are_marginals(spark, vocab, rounds):
    from pyspark.sql import functions as F

    rows = [(1, "The cat the CAT", True), (2, "hat that ñu", True), (3, "that cat 😀x", False), (4, None, True),
            (5, "", False), (6, "the\ncat\tsat", True), (6, "the\ncat\tsat", True)]
    d = spark.createDataFrame(rows, "doc_id long, text string, flag boolean")
    got = lattice.score(d, F.col("flag"), VOCAB, rounds=rounds).collect()
    want = whole_scores(rows, *vocab, rounds)
    assert sorted((r.doc_id, round(r.score, 9)) for r in got) == sorted((i, round(s, 9)) for i, s in want)


def test_packed_arcs_come_back(vocab):
    pieces, log_p = vocab
    made = lattice.Lattice.of(["hello", "日本", "q" * 40, ""], pieces)
    again = lattice.Lattice.unpack(made.pack())
    a, b = np.zeros(len(log_p)), np.zeros(len(log_p))
    weight = np.array([3.0, 1.0, 0.0, 2.0])
    assert list(made.forward(log_p, a, weight)) == list(again.forward(log_p, b, weight))
    assert (a == b).all()


def test_blocks_share_few_buckets(spark, edge, monkeypatch):
    from pyspark.sql import functions as F
    from tabclass.llm import blocks

    want = sorted(r.score for r in lattice.score(edge, F.lit(True), VOCAB, rounds=1).collect())
    monkeypatch.setattr(blocks, "BUCKETS", 2)
    monkeypatch.setattr(blocks, "BLOCK", 64)
    got = sorted(r.score for r in lattice.score(edge, F.lit(True), VOCAB, rounds=1).collect())
    assert got == pytest.approx(want)


def test_lattice_edge_rows(edge, empty):
    from pyspark.sql import functions as F

    for train, flag in ((F.col("doc_id") != 3, lambda i: i != 3), (F.lit(False), lambda i: False)):
        rows = lattice.score(edge, train, VOCAB, rounds=1).collect()
        # a null id is neither equal nor unequal to 3 and trains, unless nothing does
        n, want = base_scores([(i, t, flag(i)) for i, t, _, _ in ROWS])
        assert all(r.train_tokens == n for r in rows)
        assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == \
            sorted((i or -1, a, b, round(s, 6)) for i, a, b, s in want)
        assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lattice.score(empty, F.lit(True), VOCAB).count() == 0


def test_lattice_learns(spark):
    import __spark_entry__ as E

    rows = E.queries()["op1_subword_lattice"](spark, SF_TINY).collect()
    held = [r for r in rows if r.held_out]
    assert held and len(rows) == 200
    prior, log_p = lattice.read_vocabulary(VOCAB), None
    d = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()}
    untrained = sum(lattice.forward([w.decode() for w in (d[r.doc_id] or "").encode().lower().split()],
                                    prior[0], prior[1]).sum() for r in held) / math.log(10)
    assert sum(r.score for r in held) > 1.0 * untrained  # both negative: less is lost


# -------------------------------------------------------------- Kneser-Ney
def test_grams_stay_inside_texts():
    x = kn.symbols(["ab", "", "c\x01"])
    g, last = kn.grams(x)
    assert len(g) == 3 + 1 + 3 and list(np.flatnonzero(last)) == [2, 3, 6]
    assert g[0] == ord("a") and g[3] == kn.END and g[4] == ord("c")


def dictionary_model(texts):
    """The same model with dictionaries: probability of a symbol after a context."""
    counts = {5: Counter()}
    for t in texts:
        s = [0] * 4 + [ord(c) for c in t] + [1]
        for i in range(4, len(s)):
            counts[5][tuple(s[i - 4:i + 1])] += 1
    for k in (4, 3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc = {k: kn.discounts([sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
    ctx = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            ctx[k][g[:-1]].append(v)

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / kn.SYMBOLS
        seen = ctx[k].get(g[:-1])
        if not seen:
            return low
        c, d = counts[k].get(g, 0), disc[k]
        cut = 0 if not c else d[min(c, 3) - 1]
        return (c - cut) / sum(seen) + sum(d[min(v, 3) - 1] for v in seen) / sum(seen) * low
    return p


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the end", "that hat"] * 2 + ["zebra"]


def test_model_equals_dictionaries_and_sums_to_one(spark):
    d = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    model, p = kn.Model(kn.count_grams(d)), dictionary_model(TEXTS)
    pack = lambda g: sum(x << (12 * (4 - i)) for i, x in enumerate(g))
    contexts = [(0, 0, 0, 0), tuple(map(ord, "the ")), tuple(map(ord, "xyzq")), tuple(map(ord, " dog"))]
    for h in contexts[:2]:
        ask = spark.range(kn.SYMBOLS).selectExpr(f"{pack(h + (0,))}L + id AS g")
        assert model.score(ask).selectExpr("sum(pow(10D, lp)) s").first().s == pytest.approx(1.0)
    asked = {pack(h + (w,)): h + (w,) for h in contexts for w in (*map(ord, "abet "), 1, 3000)}
    got = model.score(spark.createDataFrame([(k,) for k in asked], "g long")).collect()
    assert {r.g: r.lp for r in got} == pytest.approx({k: math.log10(p(g)) for k, g in asked.items()})


def test_perplexity_equals_dictionaries(spark, edge):
    d = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    model, p = kn.Model(kn.count_grams(d)), dictionary_model(TEXTS)
    ask = spark.createDataFrame([(i, t) for i, t in enumerate(["the cat", "", None, "zzz zzz", "THE END"])], "doc_id long, text string")
    for r in kn.perplexity(ask, model).collect():
        s = [0] * 4 + [ord(c) for c in r.text or ""] + [1]
        want = -sum(math.log10(p(tuple(s[i - 4:i + 1]))) for i in range(4, len(s))) / (len(s) - 4)
        assert r.log_ppl == pytest.approx(want) and r.n_symbols == len(s) - 4


def test_classifier_edge_rows(spark, edge, empty):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 7, 8)] + [(None, 1), (9, 0)], "doc_id long, quality int")
    for lab in (labels, labels.where("false")):
        out = kn.keep_good(edge, lab, F.col("quality") == 1)
        assert out.columns == edge.columns
        rows = out.collect()
        if lab is not labels:  # nothing is trusted: everything stays
            assert len(rows) == len(ROWS)
    out, log_ppl, limit, kept = kn.classify(edge, labels, F.col("quality") == 1)
    assert (log_ppl, limit, kept) == ("_log_ppl", "_limit", "_kept") and out.count() == len(ROWS)
    assert kn.keep_good(empty, labels, F.col("quality") == 1).count() == 0


def test_wide_characters_are_told_apart(spark):
    texts = ["日本語の文章です", "日本語を書く", "あいうえお", "한국어 문장", "नमस्ते", "ok 😀"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kn.Model(kn.count_grams(d))
    other = "".join(chr(ord(c) ^ 1) for c in texts[0])  # every character its neighbour
    ask = spark.createDataFrame([(0, texts[0]), (1, other)], "doc_id long, text string")
    got = {r.doc_id: r.log_ppl for r in kn.perplexity(ask, model).collect()}
    assert got[0] < got[1] - 0.1
    every = [chr(c) for c in range(2, 0x110000, 7)]
    assert len({tuple(kn.symbols([c])[kn.ORDER - 1:]) for c in every}) == len(every)
    assert kn.symbols(["".join(every)]).max() < kn.SYMBOLS


def test_thresholds_by_language(spark):
    scored = spark.createDataFrame([(i, "en" if i < 200 else "xx", i / 1000) for i in range(210)],
                                   "doc_id long, lang string, log_ppl double")
    trusted = spark.createDataFrame([(i, True) for i in range(210)], "trusted_id long, held_out boolean")
    rows = kn.thresholds(scored, trusted, "doc_id", "lang", "log_ppl", quantile=0.5, slack=1.0).collect()
    got = {(r.lang, r.pooled): r["limit"] for r in rows}
    # every language has its own quantile, whatever its size
    assert {(r.lang, r.pooled, r.n) for r in rows} == {("en", False, 200), ("xx", False, 10), (None, True, 210)}
    assert got[("en", False)] == pytest.approx(0.0991, abs=1e-3)
    assert got[("xx", False)] == pytest.approx(0.2041, abs=1e-3)


def test_limits_are_drawn_to_the_pooled_one():
    assert kn.drawn(2.0, 0, 1.0) == 1.0 and kn.drawn(2.0, kn.SHRINK, 1.0) == 1.5
    steps = [kn.drawn(2.0, n, 1.0) for n in range(1000)]
    assert max(b - a for a, b in zip(steps, steps[1:])) == steps[1] - steps[0] < 0.02  # no jump at any size


def test_thresholds_use_all_trusted_documents(spark):
    labels = spark.createDataFrame([(i % 1000, 1) for i in range(1200)] + [(None, 1), (2000, 0)], "doc_id long, quality int")
    t = kn.trusted_ids(labels, "doc_id", labels.quality == 1, rows=50).collect()
    assert sorted(r.trusted_id for r in t) == list(range(1000))
    train = sum(not r.held_out for r in t)
    assert 0 < train <= 50 and len(t) - train >= 950
    scored = spark.createDataFrame([(i, "xx" if i % 10 == 0 else "en", i / 1000) for i in range(1000)],
                                   "doc_id long, lang string, log_ppl double")
    trusted = kn.trusted_ids(labels, "doc_id", labels.quality == 1, rows=50)
    lim = kn.thresholds(scored, trusted, "doc_id", "lang", "log_ppl", slack=1.0).collect()
    assert {r.lang for r in lim} == {"en", "xx", None}  # the sample has about five of "xx"
    assert kn.trusted_ids(labels.where("false"), "doc_id", labels.quality == 1).count() == 0


def test_all_trusted_documents_train_or_are_held_out(spark):
    n = 120_000  # more than any bound there was
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality")
    got = {r.held_out: r["count"] for r in
           kn.trusted_ids(labels, "doc_id", labels.quality == 1).groupBy("held_out").count().collect()}
    assert sum(got.values()) == n and abs(got[False] - 0.8 * n) < 0.01 * n


def test_training_shuffles_ids_and_no_texts(spark, edge, monkeypatch):
    """With more trusted ids than Spark broadcasts, the counts are those of a plain join and no exchange carries texts or blobs."""
    import re

    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(i, 1) for i in (*range(12), 99)] + [(None, 1), (3, 1)], "doc_id long, quality int")
    trusted = kn.trusted_ids(labels, "doc_id", F.col("quality") == 1)
    train = [r.trusted_id for r in trusted.where("not held_out").collect()]
    texts = [r for r in edge.select("doc_id", "text").collect() if r.doc_id in train]
    assert 3 in train and len(texts) < len(ROWS)  # a repeated row counts twice
    seen = {}

    class Look(kn.Model):
        def __init__(self, counts):
            seen["plan"] = counts._sc._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "formatted")
            seen["counts"] = {r.g: r.c for r in counts.collect()}

    monkeypatch.setattr(kn, "Model", Look)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kn.fit(edge, trusted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = Counter(kn.grams(kn.symbols([r.text or "" for r in texts]))[0].tolist())
    assert seen["counts"] == dict(want)
    moved = re.findall(r"Exchange\s*\nInput \[\d+\]: \[(.*)\]", seen["plan"])
    assert moved and not any("text" in m or "blob" in m for m in moved)


def test_trusted_and_junk_are_told_apart(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    got = {r.doc_id: r.kept for r in E.queries()["op9_kneser_ney"](spark, SF_SMALL).collect()}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    good = [got[r.doc_id] for r in labels if r.quality == 1]
    bad = [got[r.doc_id] for r in labels if r.quality == 0]
    assert len(got) == 1000 and sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def longest_run(text):
    best = n = 0
    last = None
    for w in text.split():
        n = n + 1 if w == last else 1
        best, last = max(best, n), w
    return best


def test_worst_passage():
    cost = np.array([1.0] * 1000 + [3.0] * 300 + [1.0] * 1000)
    assert kn.worst_passage(cost) == pytest.approx(3.0)
    assert kn.worst_passage(cost[950:1050]) == pytest.approx(2.0)  # shorter than a passage
    assert kn.worst_passage(np.array([0.5])) == 0.5


def test_runs_of_one_word_are_rejected(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    got = {r.doc_id: r for r in E.queries()["op9_kneser_ney"](spark, SF_SMALL).collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect() if r.quality == 0}
    runs = [r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
            if r.doc_id in bad and longest_run(r.text or "") >= 10]
    assert len(runs) >= 5 and sum(got[i].kept for i in runs) / len(runs) < 0.25
    assert sum(got[i].perplexity <= got[i].threshold for i in runs) / len(runs) > 0.25  # the whole text hides them


def test_arcs_are_held_in_bounded_pieces(spark, vocab, monkeypatch):
    """Long words are cut into batches by their characters, and a reader of the arcs holds a small row group."""
    import pyarrow.parquet as pq

    words = [chr(97 + i % 26) * 900 + str(i) for i in range(3000)]
    got = list(lattice.batches_of([*words, "x" * 100_000]))
    assert sorted(i for b in got for i in b) == list(range(3001))
    assert max(sum(len(words[i]) + 1 for i in b) for b in got if 3000 not in b) <= lattice.CHARS and [3000] in got
    monkeypatch.setattr(lattice, "ROW_GROUP", 1 << 20)
    d = spark.createDataFrame([(w.encode(), i % 2) for i, w in enumerate(words)], "word binary, c long").coalesce(1)
    arcs = lattice.write_arcs(d, vocab[0])
    assert arcs.selectExpr("sum(size(word)) AS n").first().n == len(words)
    groups = [m.row_group(i).total_byte_size for f in arcs.inputFiles()
              for m in [pq.ParquetFile(f.removeprefix("file:").replace("//", "/")).metadata] for i in range(m.num_row_groups)]
    assert len(groups) > 1 and max(groups) < 8 << 20
