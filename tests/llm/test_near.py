"""SimHash and vantage-point trees: against all pairs on small sets."""

import random

import numpy as np
import xxhash

from tabclass.llm import graph, simhash
from tests.conftest import SF_TINY
from tests.llm.conftest import ROWS


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(points, radius=2):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    p = np.array(points, dtype=np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p[i + 1:] ^ p[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(p))]


def test_query_equals_all_pairs(spark):
    import __spark_entry__ as E

    docs = sorted(spark.read.parquet(f"{SF_TINY}/documents.parquet").collect(), key=lambda r: r.doc_id)
    fp = [plain_fingerprint(r.text) for r in docs]
    root = classes(fp)
    want = {d.doc_id: (f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fp, root, strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in E.queries()["op10_simhash_vp"](spark, SF_TINY).collect()}
    assert got == want


def clouds(seed, n_random, n_balls, ball):
    r = random.Random(seed)
    points = {r.getrandbits(64) for _ in range(n_random)}
    for _ in range(n_balls):
        x = r.getrandbits(64)
        for _ in range(ball):  # a chain of close points and its neighbours
            x ^= 1 << r.randrange(64)
            points |= {x, x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))}
    return np.sort(np.array(list(points), dtype=np.uint64))


def test_shard_links_lose_nothing(monkeypatch):
    for leaf, dense in ((8, 20000), (128, 20000), (8, 4)):  # also where dense balls are looked up
        monkeypatch.setattr(simhash, "LEAF", leaf)
        monkeypatch.setattr(simhash, "DENSE", dense)
        x = clouds(leaf + dense, 300, 5, 40)
        a, b = simhash.shard_links(x, 2)
        at = {int(v): i for i, v in enumerate(x)}
        got = simhash.forest(len(x), np.array([at[int(v)] for v in a]), np.array([at[int(v)] for v in b]))
        assert list(got) == classes(x)


def test_shards_overlap_enough(spark):
    x = clouds(5, 2000, 20, 30)
    d = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    root = {r.node: r.root for r in graph.components(simhash.links(d, 2, shard=100, sample=500)).collect()}
    by, want = {}, {}
    for i, (v, r) in enumerate(zip(x.view(np.int64).tolist(), classes(x), strict=True)):
        by.setdefault(root.get(v, v), set()).add(i)
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_chains(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_edge_rows(edge, empty):
    rows = simhash.near_groups(edge).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert by[4].fp == by[5].fp == by[6].fp == 0 and by[6].component_id == 4
    left = simhash.drop_near(edge)
    assert left.columns == edge.columns
    assert {1, 4} <= {r.doc_id for r in left.collect()} and not {2, 3, 5, 6} & {r.doc_id for r in left.collect()}
    assert simhash.near_groups(empty).count() == 0 and simhash.drop_near(empty).count() == 0


def test_no_component_is_lost_where_ids_repeat(spark):
    d = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "A B C"), (None, "x y z"), (None, "p q r"),
                               (None, "P q r"), (0, "x y z")], "doc_id long, text string")
    left = sorted((r.text, r.doc_id) for r in simhash.drop_near(d).collect())
    assert left[0] == ("a b c", 1) and ("x y z", 0) in left and len(left) == 3
    assert {t.lower() for t, _ in left} == {"a b c", "x y z", "p q r"}
