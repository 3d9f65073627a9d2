import random

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from tidemark.llm import near_copies as nc
from tidemark.llm.components import components


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, percent=85):
    """Smallest reachable id by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    pairs = {(h[x], h[y]) for h in holders.values() for x in range(len(h)) for y in range(x + 1, len(h))}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(df):
    return {r.doc: (r.n_shingles, r.component) for r in df.collect()}


def family(rng, size, copies, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(size)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("small, large", [(64, 4096), (8, 32)])
def test_families_at_the_border(spark, monkeypatch, small, large):
    """Similarities on both sides of the border; with tiny nodes also branching and chunk pairs."""
    monkeypatch.setattr(nc, "SMALL", small)
    monkeypatch.setattr(nc, "LARGE", large)
    monkeypatch.setattr(nc, "LEVELS", 3)
    rng = random.Random(5)
    texts = [t for _ in range(12) for t in family(rng, 120, 14, 4)] + list(family(rng, 300, 90, 9))
    texts += ["same words in every one of these copies here"] * 20 + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(50)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(nc.near_copies(docs)) == brute(rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_branching_in_a_node(monkeypatch, percent):
    """One node with many members, compared where they are: as all pairs."""
    monkeypatch.setattr(nc, "SMALL", 8)
    rng = random.Random(9)
    texts = [t for _ in range(5) for t in family(rng, 200, 25, 8)]
    words = nc.Hashed()
    sketch = np.array([np.frombuffer(nc.signature(nc.shingles(t, words))[1], np.uint8) for t in texts])
    n = len(texts)
    node = np.zeros(n, np.int64)
    for trial in range(29):  # further trees, as other nodes with the same members
        node = np.r_[node, np.full(n, trial + 1)]
    rep = np.tile(np.arange(n), 30)
    search = nc.Confirm(node, sketch[rep], rep, percent, rep, pa.array([texts[i] for i in rep]))
    search.run()
    up = list(range(n))

    def root(i):
        return i if up[i] == i else root(up[i])

    for a, b in search.links:
        x, y = root(rep[a]), root(rep[b])
        up[max(x, y)] = min(x, y)
    want = brute(list(enumerate(texts)), percent)
    assert [root(i) for i in range(n)] == [want[i][1] for i in range(n)]
    forest = nc.Propose(node, sketch[rep], rep, percent)
    forest.run()
    assert len(forest.links) < n


def test_chain_of_links(spark):
    words = [f"w{i}" for i in range(1000)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 200])) for i in range(60)]
    got = found(nc.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == brute(rows) and {c for _, c in got.values()} == {0}


def test_odd_rows(spark):
    rows = [(5, "One two\tTHREE"), (3, "one TWO three"), (9, None), (8, ""), (7, " \n "), (None, "one two three"), (None, None), (3, "one TWO three"), (11, "Ä ö ß x y z"), (10, "ä ö ß x y z"), (20, "w " * 40_000), (21, "w " * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as rep", "2 as node", "'x' as component")
    got = nc.near_copies(docs)
    assert got.count() == len(rows)
    assert {k: v for k, v in found(got).items() if k is not None} == brute([r for r in rows if r[0] is not None])
    kept = nc.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, ""), (0, "one two three"), (3, "one TWO three"), (7, " \n "), (8, ""), (9, ""), (10, "ä ö ß x y z"), (11, "Ä ö ß x y z"), (20, "w " * 40_000)])
    assert nc.near_copies(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(200)]
    up = {}
    for a, b in edges:
        if a == b:
            continue
        up.setdefault(a, a), up.setdefault(b, b)
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)

    def root(i):
        return i if up[i] == i else root(up[i])

    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: root(i) for i in up}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    s = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    t = np.unique(np.r_[s[:850], rng.integers(0, 1 << 63, 150, dtype=np.uint64)])
    equal = np.mean(np.frombuffer(nc.signature(s)[1], np.uint8) == np.frombuffer(nc.signature(t)[1], np.uint8))
    assert abs(equal - 850 / 1150) < 0.13


def test_whole_test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in entry.queries()["op6_near_copies"](spark, sf).collect()}
    assert got == brute(rows)
