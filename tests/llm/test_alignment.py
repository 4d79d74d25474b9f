"""Cross-tokenizer alignment: against a plain statement of it, and the defined edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from tabclass.llm import alignment as A
from tests.conftest import SF_TINY
from tests.llm.conftest import ROWS

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    return A.ByteLevel(open(BYTE, encoding="utf-8").read()), A.Pieces(open(PIECE, "rb").read())


@pytest.fixture(scope="module")
def plain():
    """Groups of a text from both libraries as they are, by byte offsets."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    alphabet = {c: b for b, c in A.byte_alphabet().items()}
    assert decoders.ByteLevel().decode(["Ġa"]) == " a" and alphabet["Ġ"] == 32

    def bytes_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    def groups(text):
        e = tok.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
        b = [(i, bytes_b(i)) for i in sp.encode(text)]
        want = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return None
        ends = []
        for side in (a, b):
            n, at = 0, []
            for _, x in side:
                n += len(x)
                at.append(n)
            ends.append(at)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        out, lo = [], 0
        for c in cuts:
            out.append(tuple([i for (i, _), z in zip(side, at, strict=True) if lo < z <= c]
                             for side, at in zip((a, b), ends, strict=True)))
            lo = c
        return out

    return groups


def expected(docs, groups):
    aligned = [(i, groups(t or "")) for i, t in docs]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for _, g in aligned]
    count = Counter(p for n in links for p in n)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = Counter()
    for (i, g), n in zip(aligned, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out[i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(n.values()),
            hashlib.sha256(text.encode()).hexdigest() if g is not None else "", text,
            sum(k for p, k in n.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in n.items())] += 1
    return out


TEXTS = ["The quick brown fox.", "  two  spaces ", "Étion dans çouelle\nun éonierç", "a\tb\r\n\n\nc", "日本語 テキスト 😀 ok",
         "<|endoftext|> <s> </s> <unk> <0x41>", "under▁score", "a\x00b", "won't I'll it's 12345 678", "\n", " ", "ﬁ ½ Å ＡＢ", "x" * 9000,
         "trailing space ", "…“quoted”—dash", "ḀḁḂ ꙮ \U0001f1e9\U0001f1ea", " line\u0085sep nbsp", "The quick brown fox.", None, ""]


@pytest.mark.parametrize("sizes", [{}, {"block": 1, "remember": 3}])
def test_against_plain(spark, plain, sizes):
    docs = [(i if i % 7 else None, t) for i, t in enumerate(TEXTS + [t for _, t, _, _ in ROWS if t is None or len(t) < 60000])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = A.align(d, BYTE, PIECE, with_groups=True, **sizes)
    assert Counter(tuple(r) for r in out.collect()) == expected(docs, plain)


def test_registered_query(spark, plain):
    import __spark_entry__ as E

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()]
    got = E.queries()["op12_token_alignment"](spark, SF_TINY)
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    want = Counter()
    for k, n in expected(docs, plain).items():
        want[k[:6] + k[7:]] += n
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == want


def test_both_libraries_give_the_same_ids(sides):
    """The fast way for Latin text, against the tokenizer of the file."""
    a, rnd = sides[0], random.Random(5)
    assert a.fast is not None
    alphabet = [chr(c) for c in range(0x250)] + list("–—‘’“”…") + [" "] * 60 + ["\n"] * 20 + ["'s", "'ll", "<|endoftext|>"] * 5
    for n in [3] * 300 + [40] * 300 + [400] * 30:
        t = "".join(rnd.choice(alphabet) for _ in range(n))
        assert not A.OTHER.search(t)
        assert a.encode([t])[0] == a.slow.encode(t, add_special_tokens=False).ids, repr(t)


def test_very_long_texts(sides):
    aligner = A.Aligner(*sides)
    for t in (" " * 300_000 + "a", "x" * 400_000, "word " * 100_000, "日本" * 50_000):
        (row,), doc, pair, linked = aligner.documents([t])
        assert row[0] and row[3] == linked.sum() and set(doc) == {0} and len(set(pair)) == len(pair)


def test_windows_are_remembered(sides):
    """Windows end at shared ends before space-marked tokens: a word is learnt once."""
    aligner = A.Aligner(*sides)
    aligner.documents(["one two one two one"])
    n = len(aligner.number)
    aligner.documents(["two one", "one"])
    assert n == len(aligner.number) == 2


def test_edge_tables(spark, edge, empty):
    out = A.align(edge, BYTE, PIECE)
    assert out.count() == len(ROWS)
    assert A.align(empty, BYTE, PIECE).count() == 0
    none = edge.where("text IS NULL OR text = ''")
    assert [tuple(r)[1:] for r in A.align(none, BYTE, PIECE).collect()] == [(0, 0, 0, 0, "", 0, 0)] * none.count()
