"""Prefix trie: against SQL, a plain trie, and the defined edge cases."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tabclass.llm import prefix_trie as T
from tests.conftest import SF_TINY
from tests.test_oracle_parity import _rows

COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def key_of(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def rebuilt(rows, group=100, heads=lambda c: zlib.crc32(str(c).encode()) % 6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, key_of(role, text)), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    return {c: own.get(c - c % group, [])[:heads(c)] + v[heads(c):] for c, v in own.items()}


def plain(convs):
    """Rows of a trie built one turn at a time."""
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
            if d:
                children[tuple(convs[c][:d - 1])].add(tuple(convs[c][:d]))
    out, sums = [], {}
    for path in sorted(members, key=len, reverse=True):
        kids = [sums[k] for k in children[path]]
        own = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        sums[path] = (sum(k[0] for k in kids) or 1, own + sum(k[1] for k in kids))
        ends = ",".join(str(c) for c in members[path] if len(convs[c]) == len(path))
        out.append((members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(kids),
                    *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **sizes):
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = T.trie(T.with_shared_heads(T.ordered_turns(d), T.heads_by_crc()), **sizes)
    assert tuple(out.columns) == COLS
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_sql_parity(spark, duck):
    import __spark_entry__ as E

    df = E.queries()["op13_prefix_trie"](spark, SF_TINY)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()["op13_prefix_trie"])
    names = [d[0] for d in cur.description]
    idx = [names.index(c) for c in df.columns]
    assert got == _rows(df.columns, [tuple(r[i] for i in idx) for r in cur.fetchall()])


ROWS = [(c, t, "user" if t % 2 == 0 else "assistant", f"hi {t % 3}" if t < 2 + c % 4 else f"own {c} {t}")
        for c in range(0, 260, 3) for t in range(c % 8)]
ROWS += [(c, t, "user", "same") for c in range(100, 140) for t in range(6)]          # a group of copies
ROWS += [(300, t, "u", "deep " * (t % 3)) for t in range(60)]                        # one long conversation
ROWS += [(399, t, "u", "deep " * (t % 3)) for t in range(40)] + [(398, t, "u", "deep " * (t % 3)) for t in range(60)]
ROWS += [(501, None, None, None), (501, None, "a", "x"), (501, 0, "a", "x"), (501, 0, "a", "x"), (502, 1, None, ""),
         (None, 0, "a", "x"), (700, -5, "é", "日本 😀"), (701, 3, "é", "日本 😀"), (702, 3, "aa", "b"), (703, 3, "a", "ab"),
         (901, 0, "u", "x" * 200000), (902, 0, "u", "x" * 200000), (902, 1, "u", "x")]


@pytest.mark.parametrize("sizes", [{}, {"shard": 1, "slab_rows": 1}, {"shard": 7, "slab_rows": 5}, {"shard": 64, "slab_rows": 30}])
def test_against_plain_trie(spark, sizes):
    assert run(spark, ROWS, **sizes) == plain(rebuilt(ROWS))


def test_turnless_and_empty(spark):
    """Conversations whose only turns are replaced by a missing head; no rows at all."""
    few = [(c, 0, "u", "a") for c in range(1001, 1060)]
    convs = rebuilt(few)
    assert any(not v for v in convs.values())
    assert run(spark, few) == plain(convs)
    assert run(spark, []) == []


def test_extra_columns_with_clashing_names(spark):
    d = spark.createDataFrame([r + ("x",) * 4 for r in ROWS], "conv_id long, turn long, role string, text string, "
                              "pos string, digest string, key string, shard string")
    out = T.trie(T.with_shared_heads(T.ordered_turns(d), T.heads_by_crc()))
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rebuilt(ROWS))


def test_shards_share_no_rows(spark):
    """A walk over two shards keeps each one's nodes, in slabs of one position too."""
    seen = []
    w = T.Shard(lambda *n: seen.append(n))
    w.begin([4, 9, 12])
    w.slab(0, [(4, 0, b"a", 1), (9, 0, b"a", 1), (12, 0, b"b", 2)], False)
    w.slab(1, [(9, 1, b"c", 3)], True)
    assert [(n[2], n[3], n[4], n[5], n[6]) for n in seen] == [
        (0, 3, 4, 0, ""), (1, 2, 4, 1, "4"), (2, 1, 9, 3, "9"), (1, 1, 12, 2, "12")]
