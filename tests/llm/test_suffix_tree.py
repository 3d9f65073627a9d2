import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from tidemark.llm import suffix_tree as st
from tidemark.llm.blocks import Wide, dealt, keys_of, read_counts, small_counts, small_keys, summed


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w] + [None]


def word_context(ts, j):
    for m in range(1, st.WORDS + 1):
        words = ts[max(0, j - m) : j]
        if m >= j or sum(len(w.encode()) + 1 for w in words) >= st.WORD_CONTEXT:
            break
    return tuple(words)


def trained(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0


def base_scores(rows):
    count = Counter(w for i, t in rows if trained(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    return [(not trained(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t in rows]


def naive_bytes(tree, text):
    """Log probability of every byte: the longest suffix held by the tree, smoothed step by step."""
    data = st.END * st.CONTEXT + st.spelled_bytes((text or '').encode())
    out = []
    for at in range(st.CONTEXT, len(data)):
        p, longest = 1 / 256, 0
        for k in range(st.CONTEXT + 1):
            if data[at - k : at] in tree:
                longest = k
        for k in range(longest + 1):
            own = tree.get(data[at - k : at])
            if own:
                p = (own.get(data[at], 0) + st.SMOOTHING * p) / (sum(own.values()) + st.SMOOTHING)
        out.append(math.log(p))
    return out


def naive_tree(rows):
    """Contexts that pass the tests, with their suffixes, counted byte by byte."""
    counts = {}
    for i, t in rows:
        if trained(i):
            data = st.END * st.CONTEXT + st.spelled_bytes((t or '').encode())
            for at in range(st.CONTEXT, len(data)):
                for k in range(st.CONTEXT + 1):
                    counts.setdefault(data[at - k : at], Counter())[data[at]] += 1
    whole = sum(counts[b""].values())
    frequent = {c: n for c, n in counts.items() if sum(n.values()) >= st.LEAST_SHARE * whole}
    kept = {b""}
    for c, n in frequent.items():
        if c:
            total, p = sum(n.values()), frequent[c[1:]]
            pt = sum(p.values())
            if sum(x * math.log((x / total) / (p[b] / pt)) for b, x in n.items()) >= st.DIVERGENCE:
                kept |= {c[k:] for k in range(len(c))}
    return {c: counts[c] for c in kept}


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def test_like_brute_force(spark, rows):
    rows = sorted(rows, key=lambda r: len(r[1]))[:60] + [(None, "No id here"), (10_000, None), (10_001, ""), (rows[0][0], "Again the of")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as id", "2 as block", "3 as score")
    got = sorted(st.score_texts(docs).collect(), key=lambda r: (r.n_tokens, r.base_score))
    want = sorted(zip(rows, base_scores(rows), strict=True), key=lambda x: (x[1][1], x[1][4]))
    tree = naive_tree(rows)
    total = Counter(w for i, t in rows if trained(i) for w in tokens(t))
    n = sum(total.values())
    pairs = defaultdict(Counter)
    for i, t in rows:
        for j, w in enumerate(tokens(t) if trained(i) else []):
            pairs[word_context(tokens(t), j)][w] += 1
    entropy = -sum(c / n * math.log(c / n) for c in total.values())
    spelling = min(0.5, max(1e-3, sum(c == 1 for c in total.values()) / n))
    for r, ((i, t), b) in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, *b[:4])
        assert r.base_score == pytest.approx(b[4], rel=1e-9)
        logs = naive_bytes(tree, t)
        assert r.spelled_score == pytest.approx(sum(logs) / math.log(10), rel=1e-5, abs=1e-5)
        at, score, ts = 0, 0.0, tokens(t)
        for j, w in enumerate(ts):
            size = 1 if w is None else len(w.encode()) + 1
            p = spelling * math.exp(sum(logs[at : at + size])) + (1 - spelling) * total[w] / n
            near = pairs[word_context(ts, j)]
            met, kinds = sum(near.values()), len(near)
            spread = sum(x * math.log(met / x) for x in near.values())
            if kinds < met and met * entropy - spread > kinds * entropy:
                p = (near[w] + kinds * p) / (met + kinds)
            score += math.log10(p)
            at += size
        assert r.score == pytest.approx(score, rel=1e-5, abs=1e-5)


def test_next_bytes_sum_to_one():
    tree = [(0, 0, 97, 5), (0, 0, 98, 5), (1, 97, 98, 4), (3, 0x616261, 98, 2), (2, 0x6261, 98, 3)]
    a = st.Automaton(*(np.array(x, np.int64) for x in zip(*tree, strict=True)))
    assert np.allclose(np.exp(a.log.reshape(-1, 256)).sum(axis=1), 1, atol=1e-4)


def test_held_out_texts_score_better_than_base(spark):
    got = [r for r in entry.queries()["op2_suffix_tree"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(got) > 50
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_small_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert [r.n_tokens for r in st.score_texts(docs).collect()] == [1, 1]
    assert st.score_texts(docs.limit(0)).count() == 0
    lone = spark.createDataFrame([(10, "x y")], "doc_id bigint, text string")
    assert all(math.isfinite(r.score) for r in st.score_texts(lone, held_out_mod=1).collect())


def test_packed_counts():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    counts = np.arange(len(keys)) * 70
    rows = dealt(7, keys, counts, 5).to_pylist()
    assert [r["part"] for r in rows] == [0, 1, 2, 3, 4] and {r["block"] for r in rows} == {7}
    assert np.array_equal(np.concatenate([keys_of(r["keys"]) for r in rows]), keys)
    assert np.array_equal(np.concatenate([read_counts(r["counts"]) for r in rows]), counts)
    every, sums = summed([keys, keys[:10]], [counts, counts[:10]])
    assert np.array_equal(every, keys) and sums[9] == 2 * counts[9] and sums[10] == counts[10]
    for top in (0, 255, 256, 70_000, 1 << 40):
        assert read_counts(small_counts(np.array([top]))) == [top]


def test_next_tokens_of_a_rich_context_are_told_apart(spark):
    """Words never seen after a retained context share what its smoothing leaves, and get nothing else."""
    held = [i for i in range(60_000) if not trained(i)][:4000]
    own = [i for i in range(1000) if trained(i)]
    after = " ".join(f"contextword w{k:05d}" for k in range(2000) for _ in range(10))
    rows = [(own[0], after), (own[1], " ".join(f"w{k:05d}" for k in range(100_000)))]
    rows += [(i, f"contextword w{50_000 + k:05d}") for k, i in enumerate(held)]
    got = [r for r in st.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.held_out]
    gain = np.array([r.score - r.alone_score for r in got])
    assert len(gain) == 4000 and gain.max() - gain.min() < 1e-6
    assert gain[0] == pytest.approx(math.log10(2000 / (20_000 + 2000)), abs=1e-6)


def test_wide_keys():
    rng = np.random.default_rng(1)
    high, low = (rng.integers(0, n, 5000, dtype=np.uint64) for n in (700, 40))
    every, place = Wide(high, low).distinct()
    want = sorted(set(zip(high.tolist(), low.tolist(), strict=True)))
    assert list(zip(every.high.tolist(), every.low.tolist(), strict=True)) == want
    assert np.array_equal(every.high[place], high) and np.array_equal(every.low[place], low)
    back = Wide.unpacked(small_keys(every.high), every.packed(2), 2)
    assert np.array_equal(back.high, every.high) and np.array_equal(back.low, every.low)
