"""Packing, host paths, quotation linking, and the pipeline."""

import html
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabclass.llm import html_paths, packing, quotes
from tests.conftest import SF_TINY
from tests.llm.conftest import ROWS

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


# ------------------------------------------------------------------ packing
def test_encoder_equals_tokenizer(tokenizer):
    r, encode = random.Random(3), packing.Encoder(open(TOKENIZER, encoding="utf-8").read())
    alphabet = ["a", "B", "é", "日", "😀", " ", " ", "  ", "\n", "\n\n", " \n", "\t", "\r", "\x00", "\x1c", "\x85", "\xa0",
                " ", "'s", "'ll", ",", ".", "!!", "7", "<|endoftext|>", "the", " don't", "x,", "ß.", "́"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += ["", " ", "\n", " a", "a ", "\na", "a\n", "word, word. word! end.", "a <|endoftext|> b",
              "<|endoftext|><|endoftext|>", "x<|endoftext|>\n <|endoftext", " <|endoftext|>"]
    got = encode(texts)
    for t, g in zip(texts, got, strict=True):
        assert list(np.frombuffer(g, dtype="<u2")) == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_steps_to_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_pieces(rows, want, copies=1):
    """Every id in one piece; sequences gapless, full or a power of two."""
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id]) and r.length > 0
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    for i, pieces in docs.items():
        cover = Counter(k for a, n in pieces for k in range(a, a + n))
        assert cover == Counter({k: copies for k in range(len(want[i]))})


def test_packing_query(spark, tokenizer):
    import __spark_entry__ as E

    rows = E.queries()["op2_hilbert_packing"](spark, SF_TINY).collect()
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()
    want = {d.doc_id: ids_of(tokenizer, d.text) for d in docs}
    assert {r.doc_id for r in rows} == set(want)
    check_pieces(rows, want)


def test_packing_edge_rows(edge, empty, tokenizer):
    rows = packing.pack_documents(edge, TOKENIZER).collect()
    texts = {i: t for i, t, _, _ in ROWS}
    want = {i: ids_of(tokenizer, t) for i, t in texts.items()}
    total = sum(len(want[i]) for i, _, _, _ in ROWS)
    assert sum(r.length for r in rows) == total
    assert all(list(want[r.doc_id][r.start:r.start + r.length]) == r.ids for r in rows)
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_alike_documents_are_neighbours(spark):
    import __spark_entry__ as E

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()}
    rows = sorted(E.queries()["op2_hilbert_packing"](spark, SF_TINY).collect(), key=lambda r: (r.sequence_id, r.offset))
    order = [lang[r.doc_id] for r in rows]
    same = sum(a == b for a, b in zip(order, order[1:], strict=False)) / (len(order) - 1)
    share = sum((n / len(order)) ** 2 for n in Counter(order).values())
    assert same > share + 0.2


# --------------------------------------------------------------- host paths
def test_pages_of_the_tables(spark):
    import __spark_entry__ as E

    got = {r.page_id: r for r in E.queries()["op5_host_paths"](spark, SF_TINY).collect()}
    for r in spark.read.parquet(f"{SF_TINY}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        plain = re.sub(r"</?(?:p|h1|br)>", " ", re.sub("</?b>", "", article))
        want = " ".join(html.unescape(plain).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def para(n, word="word"):
    return f"<p>{' '.join([word] * n)}</p>"


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body class="page-7"><header>Top</header>
<div class="menu main-menu"><ul><li><a href=x>Home</a><li><a href='y>z'>More</a></ul></div>
<div class="post-{i} content"><h1>Caf&eacute; &#x41;&nbsp;b</h1>{body}<div class=share>Share!</div>
<ul><li>one<li>two</ul><script>if (a < b) document.write("</p>")</script><!-- <p>hidden</p> -->
<p>in<b>li</b>ne<br>next</div>
<div id="comments">{comments}</div><aside>side</aside><form><p>sign up</p></form><footer>&copy; x</footer></body></html>"""


def test_consensus_overrules_a_page(spark):
    pages = [(i, f"http://Site.example/{i}", PAGE.format(i=i, body=para(60), comments=para(3, "troll"))) for i in range(5)]
    # a page whose loudest container is a plain block of a kind the site does not use for articles
    odd = '<html><body class="page-9"><div class="post-9 content"><h1>H</h1><p>short</p></div><div>' + para(80, "noise") + "</div></body></html>"
    pages += [(5, "http://site.example/5", odd), (6, "http://other.example/", odd), (7, None, odd), (8, "http://site.example/8", None),
              (9, "http://[bad", "<p>plain"), (10, "http://third.example", "no tags at all")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_paths.extract(d).collect()}
    assert got[0] == "Café A b " + " ".join(["word"] * 60) + " one two inline next"
    assert got[5] == "H short"
    assert got[6] == got[7] == " ".join(["noise"] * 80)
    assert got[8] == "" and got[10] == "" and len(got) == 11


def read_alone(html):
    page = html_paths.Page(html)
    own = page.best()[0]
    return page.text(own) if own else page.loose()


@pytest.mark.parametrize("html,want", [
    ('<body><div class="w-1/2"><p>Half a page.</p></div></body>', "Half a page."),
    ('<body><div class="layout has-sidebar"><article><p>One.</p></article><aside>no</aside></div></body>', "One."),
    ('<body><div class="content no-ads"><p>Two.</p><div class="ads">buy</div></div></body>', "Two."),
    ('<body><div class="sidebar-layout"><div class="social-grid"><main><p>Three, a longer text.</p></main></div>'
     '<div class="sidebar">no</div></div><div class="legal">Copyright</div></body>', "Three, a longer text."),
    ('<body><div class="ad-free"><p>Four.</p><nav>menu</nav></div></body>', "Four."),
    ('<body><div id="comments"><article class="comment"><p>A long comment of a reader.</p></article></div>'
     '<div class="text"><p>Five.</p></div></body>', "Five."),
    ('<body><div class="related"><article><p>Teaser</p></article></div><div><p>Six, the text itself.</p></div></body>',
     "Six, the text itself."),
    ("<p>Seven,</p><p>without a body.</p><nav>menu</nav>", "Seven, without a body."),
    ('<a href="x">only</a> <a href="y">links</a>', ""),
    ("<body><nav>menu</nav><footer>foot</footer></body>", ""),
])
def test_wrappers_keep_their_article(html, want):
    assert read_alone(html) == want


@pytest.mark.parametrize("bad", ['<div class="ad"><article>', '<div class="ad">', '<div class="ad"><p>x</p></div>'])
def test_wrappers_are_linear(bad):
    import time

    start = time.time()
    html_paths.Page("<body>" + bad * 20000 + "text")
    assert time.time() - start < 5


def test_tied_votes(spark):
    page = '<body><div class="{}"><p>text of {}</p></div></body>'
    rows = [(i, f"http://h/{i}", page.format(c, c)) for i, c in enumerate(["a/b", "z", "a/b", "z"])]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    won = html_paths.winners(html_paths.best_paths(d)).collect()
    assert [(r.host, r.path) for r in won] == [("h", "body div.a/b")]  # a tie in votes: the longer text
    got = {r.page_id: r.text for r in html_paths.extract(d).collect()}
    assert got == {i: f"text of {c}" for i, c in enumerate(["a/b", "z", "a/b", "z"])}


def test_host_paths_edges(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, "http://a.b/", deep), (1, "http://a.b/", deep), (2, "", ""), (None, None, None),
            (3, "http://a.b/", "<p " + '"' * 5000), (4, "http://a.b/", "<" * 20000), (5, "http://c.d", "<!--" * 5000)]
    d = spark.createDataFrame([r + ("z",) for r in rows], "page_id long, url string, html string, text string")
    assert html_paths.extract(d).count() == len(rows)
    assert html_paths.extract(d.where("false")).count() == 0


def test_quoted_values_of_any_length_and_number():
    long = "x<b>y</b> a>b " * 700
    many = " ".join(f'data-a{i}="a>b{i}"' for i in range(300))
    for attrs in (f'data-state="{long}"', many, f"data-state='{long}'"):
        page = html_paths.Page(f'<body><div {attrs} class="ad">buy this</div><article><p>the text</p></article></body>')
        assert page.tags[1:] == ["body", "div", "article", "p"] and page.labels[2] == "div.ad"
        assert page.text("body") == "the text"
    page = html_paths.Page("""<body><div data-x="<p class='ad'>" class="main">it's "so"</div></body>""")
    assert page.labels[2] == "div.main" and page.text("body") == 'it\'s "so"'
    page = html_paths.Page("<body><p title='open>one</p><p>two</p></body>")  # no closing quote
    assert page.text("body") == "one two"


def test_reading_tags_is_linear():
    import time
    for bad in ('<a b=">" ', '<a b="', "<a b='> <c d=\"> ", "<a x='", "<a b='\">\" "):
        start = time.process_time()
        html_paths.Page("<body>" + bad * 40000 + " >")
        assert time.process_time() - start < 20


# ------------------------------------------------------------------- quotes
CONV = [
    (1, 0, "user", "Hello there\nHow do I pack?"),
    (1, 1, "assistant", "On Monday user wrote:\n> Hello there\n> how do  I PACK?\nUse the curve."),
    (1, 2, "user", "> > Hello there\n>> How do I pack?\n> Use the curve.\nThanks!"),
    (1, 3, "user", ">> how do i pack?\nsame question"),
    (1, 4, "user", "no quotes"),
    (2, 0, "user", ">Use the curve.\nfound elsewhere"),
    (2, 1, "user", "> never written\nplain"),
    (3, 5, "user", None), (3, 7, "user", "> found elsewhere"),
    (None, 1, "user", "> Hello there"), (4, None, "user", ""), (1, 0, "user", "Hello there\nHow do I pack?"),
]


def test_quotes_are_linked(spark):
    d = spark.createDataFrame(CONV, "conv_id long, turn int, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_threads(d).collect()}
    assert len(got) == len(set((c, t) for c, t, _, _ in CONV))
    link = {k: (r.parent_conv, r.parent_turn) for k, r in got.items()}
    assert link[(1, 0)] == (None, None) and link[(1, 1)] == (1, 0)
    assert link[(1, 2)] == (1, 1)      # the outermost level decides
    assert link[(1, 3)] == (1, 0)      # only a nested quote: its writer
    assert link[(1, 4)] == (1, 3)      # no quote: the previous turn
    assert link[(2, 0)] == (1, 1) and link[(2, 1)] == (2, 0) and link[(3, 7)] == (2, 0)
    assert {got[k].thread_id for k in [(1, 0), (2, 1), (3, 5), (3, 7)]} == {1}
    assert got[(2, 1)].depth == 3 and got[(3, 7)].depth == 3 and got[(3, 5)].depth == 0
    assert got[(1, 1)].body == "Use the curve." and got[(1, 1)].n_quoted == 2 and got[(1, 1)].n_linked == 2
    assert got[(3, 5)].body == "" and got[(None, 1)].depth == 0 and got[(4, None)].body == ""
    assert by_sql(CONV) == {k: r.asDict() for k, r in got.items()}
    for r in got.values():  # reply order: parents first
        if r.parent_conv is not None:
            assert got[(r.parent_conv, r.parent_turn)].depth == r.depth - 1
    assert quotes.reply_threads(d.where("false")).count() == 0


def by_sql(rows):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(quotes.SQL)
    names = [c[0] for c in cur.description]
    out = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    return {(r["conv_id"], r["turn"]): r for r in out}


MANY = [f"line number {i}" for i in range(3000)]
#: a shared greeting, quotes of one passage in parts, other conversations, ties, rings, a long text
PASSAGES = [
    (1, 0, "u", "Hello,\nfirst of all"), (1, 1, "u", "what else"), (1, 2, "u", "Hello,\nother"),
    (1, 3, "u", "Hello,\n\nsee below\nbye"), (1, 4, "u", "> Hello,\n> see below\nread"),
    (1, 5, "u", "> Hello,\nhi\n> see below\nthere\n> bye"),   # in parts: the whole is turn 3's
    (1, 6, "u", "> Hello,\nhi\n> other\n> not written\n> see below"),  # passages, then lines
    (3, 0, "u", "alpha\ngamma"), (5, 0, "u", "alpha\nbeta"), (6, 0, "u", "> alpha\n> beta\nok"),
    (7, 0, "u", "alpha"), (7, 1, "u", "> gamma\n> alpha\nno such order"),
    (3, 4, "u", "> alpha\n> beta\nlate"),                      # written elsewhere only
    (10, 0, "u", "ring one\n> ring two"), (11, 0, "u", "ring two\n> ring one"), (11, 1, "u", "below the ring"),
    (12, 0, "u", "> ring two\nside"), (20, 0, "u", "own\n> third"), (21, 0, "u", "second\n> own"),
    (19, 3, "u", "third\n> second"), (19, 4, "u", "after"), (22, 0, "u", "> self\nself"),
    (30, 0, "u", "\n".join(MANY)), (30, 1, "u", "> " + "\n> ".join(MANY[7:2900]) + "\nmany"),
    (30, 2, "u", "> " + "\n> ".join(MANY[7:1000] + MANY[1001:1500]) + "\none line left out"), (31, 0, "u", MANY[7]),
]


def test_passages_rings_and_ties(spark):
    d = spark.createDataFrame(PASSAGES, "conv_id long, turn int, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_threads(d).collect()}
    link = {k: (r.parent_conv, r.parent_turn, r.n_linked) for k, r in got.items()}
    assert link[(1, 4)] == (1, 3, 2) and link[(1, 5)] == (1, 3, 3)   # not the first to write "Hello,"
    assert link[(1, 6)] == (1, 0, 3)          # no passage as a whole: one line each, and of equals the first turn
    assert link[(6, 0)] == (5, 0, 2)          # not (3, 0), which has the first line only
    assert link[(3, 4)] == (5, 0, 2)
    assert link[(7, 1)] == (3, 0, 2)          # one line each: the smaller conversation
    assert link[(10, 0)] == (None, None, 1) and link[(11, 0)] == (10, 0, 1) and got[(11, 1)].depth == 2
    assert link[(19, 3)] == (None, None, 1)   # the smallest of three
    assert [got[k].depth for k in [(19, 3), (20, 0), (21, 0), (19, 4)]] == [0, 1, 2, 1]
    assert {got[k].thread_id for k in [(10, 0), (11, 0), (11, 1), (12, 0)]} == {10}
    assert link[(22, 0)] == (None, None, 0)   # nobody before it, and no other conversation, wrote the line
    assert link[(30, 1)] == (30, 0, 2893) and link[(30, 2)] == (30, 0, 1492) and link[(31, 0)] == (None, None, 0)
    for r in got.values():
        if r.parent_conv is not None:
            assert got[(r.parent_conv, r.parent_turn)].depth == r.depth - 1
    assert by_sql(PASSAGES) == {k: r.asDict() for k, r in got.items()}


def test_random_quotes_equal_the_sql(spark):
    rng = random.Random(11)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 6)):
            lines = [rng.choice(["", "> ", ">> ", "", "> "]) + rng.choice("abcde") * rng.randint(0, 2)
                     for _ in range(rng.randint(0, 9))]
            rows.append((c, t, "u", "\n".join(lines)))
    d = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    got = {(r.conv_id, r.turn): r.asDict() for r in quotes.reply_threads(d).collect()}
    assert got == by_sql(rows)


def test_long_conversation_and_shared_lines(spark):
    rows = [(1, t, "user", "thanks") for t in range(300)] + [(2, t, "user", "> thanks\nok") for t in range(50)]
    d = spark.createDataFrame([r + ("x",) for r in rows], "conv_id long, turn long, role string, text string, body string")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_threads(d).collect()}
    assert all(got[(1, t)].depth == t for t in range(300))
    assert all((got[(2, t)].parent_conv, got[(2, t)].parent_turn) == (1, 0) for t in range(50))


def test_quotes_query(spark):
    import __spark_entry__ as E

    rows = E.queries()["op3_quote_threads"](spark, SF_TINY).collect()
    conv = spark.read.parquet(f"{SF_TINY}/conversations.parquet").collect()
    turns = {(r.conv_id, r.turn) for r in conv}
    assert {(r.conv_id, r.turn) for r in rows} == turns and len(rows) == len(turns)
    for r in rows:  # these texts quote nothing: replies follow the turns
        assert r.n_quoted == 0 and r.depth == sum((r.conv_id, t) in turns for t in range(r.turn))


# ----------------------------------------------------------------- pipeline
def test_pipeline(spark, tokenizer):
    import corpus_pipeline as P
    from tests.llm.test_near import classes, plain_fingerprint

    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mix", "pack"]
    now, frames = docs, []
    for _, stage in P.STAGES:
        now = stage(spark, now, SF_TINY)
        frames.append(now.cache())
        now = frames[-1]
    text = {r.doc_id: r.text for r in docs.collect()}
    good, exact, near, mixed, packed = frames
    assert good.columns == exact.columns == near.columns == mixed.columns == docs.columns
    kept = sorted(r.doc_id for r in good.collect())
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF_TINY}/labels.parquet").where("quality = 1").collect()}
    assert len(trusted & set(kept)) >= 0.97 * len(trusted) and len(kept) < len(text)
    last = {text[i]: i for i in kept}
    assert sorted(r.doc_id for r in exact.collect()) == sorted(last.values())
    ids = sorted(last.values())
    root = classes([plain_fingerprint(text[i]) for i in ids])
    assert sorted(r.doc_id for r in near.collect()) == sorted({ids[r] for r in root})
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {ids[r] for r in root} and max(copies.values()) <= 2
    words = lambda rows: sum(len(text[i].encode().split()) * n for i, n in rows)
    assert words(copies.items()) / words((ids[r], 1) for r in set(root)) == pytest.approx(1.5, rel=0.25)
    got = Counter()
    for r in packed.collect():
        got[r.doc_id] += r.length
        assert list(ids_of(tokenizer, text[r.doc_id])[r.start:r.start + r.length]) == r.ids
    assert got == {i: n * len(ids_of(tokenizer, text[i])) for i, n in copies.items()}
    for f in frames:
        f.unpersist()
