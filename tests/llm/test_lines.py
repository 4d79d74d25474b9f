"""Line dedup: against SQL, against a plain count, and the defined edge cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabclass.llm import line_dedup
from tests.conftest import SF_TINY
from tests.llm.conftest import ROWS
from tests.test_oracle_parity import _rows

STRIP = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def plain(texts, least, min_chars=1):
    """(kept text, lines, dropped) of each text."""
    docs = [(t or "").split("\n") for t in texts]
    seen = Counter(k for d in docs for k in {key_of(x) for x in d} if len(k) >= min_chars)
    out = []
    for d in docs:
        left = [x for x in d if not (len(key_of(x)) >= min_chars and seen[key_of(x)] >= least)]
        out.append(("\n".join(left), len(d), len(d) - len(left)))
    return out


def test_sql_parity_and_native_plan(spark, duck):
    import __spark_entry__ as E

    df = E.queries()["op11_line_dedup"](spark, SF_TINY)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()["op11_line_dedup"])
    names = [d[0] for d in cur.description]
    idx = [names.index(c) for c in df.columns]
    assert got == _rows(df.columns, [tuple(r[i] for i in idx) for r in cur.fetchall()])
    assert any(r[df.columns.index("n_dropped")] not in (0, "0") for r in got)


@pytest.mark.parametrize("least", [2, 3, 5])
def test_against_plain_count(spark, least):
    texts = ["Head\nbody one\n\nFoot ", " head\t\nbody two\n\nfoot", "HEAD\nbody\none\nFOOT\x0b", "x\nhead\nx\nhead", None, "",
             "\n\n", "É\né\nÉ", "é\nÉ ", " head\n head", "foot\r\nhead\r\n", "only", "a" * 70000 + "\nhead"] + ["copy\nof\nhead"] * 4
    ids = [None if i % 5 == 4 else i // 2 for i in range(len(texts))]  # missing and repeated ids
    d = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)
    out, n, k = line_dedup.drop_common_lines(d, min_documents=least)
    got = Counter((r.doc_id, r.text, r[n], r[k]) for r in out.collect())
    assert got == Counter((i, *p) for i, p in zip(ids, plain(texts, least), strict=True))


def test_longer_keys_only(spark):
    texts = ["ab\nabcd\nx", "ab\nABCD", "q"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out, n, k = line_dedup.drop_common_lines(d, min_documents=2, min_chars=3)
    assert sorted((r.doc_id, r.text, r[n], r[k]) for r in out.collect()) == [
        (i, *p) for i, p in enumerate(plain(texts, 2, 3))]


def test_edge_rows(edge, empty):
    d = edge.withColumns({c: F.lit("x") for c in ("n_lines", "n_dropped", "_d1", "_gone", "h1", "pos", "key")})
    out, n, k = line_dedup.drop_common_lines(d, min_documents=2)
    assert out.columns == [*d.columns, n, k] and (n, k) == ("_n_lines", "_n_dropped")
    got = Counter((r.doc_id, r.text, r[n], r[k]) for r in out.collect())
    assert got == Counter((r[0], *p) for r, p in zip(ROWS, plain([r[1] for r in ROWS], 2), strict=True))
    assert out.where("key = 'x' and n_lines = 'x'").count() == len(ROWS)
    assert line_dedup.drop_common_lines(empty)[0].count() == 0


def test_many_lines_in_one_document(spark):
    """A long document whose every line is frequent; and positions keep their order."""
    long = "\n".join(f"line {i}" for i in range(30000))
    some = "\n".join(f"line {i}" if i % 3 else f"own {i}" for i in range(30000))
    d = spark.createDataFrame([(1, long), (2, some)], "doc_id long, text string")
    out, n, k = line_dedup.drop_common_lines(d, min_documents=2)
    assert sorted((r.doc_id, r.text, r[n], r[k]) for r in out.collect()) == [
        (i + 1, *p) for i, p in enumerate(plain([long, some], 2))]
