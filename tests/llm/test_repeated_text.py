import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from tidemark.llm import repeated_text as rt


def brute(rows, n=50):
    """Spans by a table of every string's smallest document."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, t in texts:
        if i is not None:
            for k in range(len(t) - n + 1):
                s = t[k : k + n]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in texts:
        covered = bytearray(len(t))
        for k in range(len(t) - n + 1) if i is not None else []:
            if first[t[k : k + n]] < i:
                covered[k : k + n] = b"\1" * n
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = sum(c and not p for p, c in zip(b"\0" + covered, covered, strict=False))
        out.append((i, len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=key)


DIGESTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("block_bytes", [24_000_000, 3_000])
def test_random_documents(spark, monkeypatch, block_bytes):
    monkeypatch.setattr("tidemark.llm.blocks.BLOCK_BYTES", block_bytes)
    rng = random.Random(4)
    words = ["the", "of", "été", "a", "straße", "in", "x"] + [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 40))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts.append(rng.choice([p, p[cut:], p[:cut], " ".join(rng.choice(words) for _ in range(30))]))
        rows.append((rng.choice([i, i - 3]), " ".join(parts)))
    rows += [(500, "ab" * 400), (501, "ab" * 30), (502, "a" * 49), (503, "a" * 50), (504, "a" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(rt.remove_repeats(docs, outputs=DIGESTS)) == sorted(brute(rows), key=key)


def test_odd_rows(spark):
    long = "one long passage of words that is over fifty bytes, surely it is."
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (5, "x" + long + "y"), (4, "é\x00" * 30), (6, "é\x00" * 28)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as id", "2 as block", "3 as kept")
    assert found(rt.remove_repeats(docs, outputs=DIGESTS)) == sorted(brute(rows), key=key)
    spans = {r.doc_id: (r.spans, bytes(r.kept)) for r in rt.remove_repeats(docs).collect()}
    assert spans[5] == ([[1, 1 + len(long)]], b"xy") and spans[3] == ([], long.encode())
    assert rt.remove_repeats(docs.limit(0)).count() == 0
    short = rt.remove_repeats(docs, min_bytes=10, outputs=DIGESTS)
    assert found(short) == sorted(brute(rows, 10), key=key)


def test_backward_extension_finds_equal_windows():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start, count = np.array([0, 150, 260]), np.array([100, 60, 90])
    sets = rt.equal_windows(data, start, count, 8)
    windows = [data[s + k : s + k + 8].tobytes() for s, c in zip(start, count, strict=True) for k in range(c)]
    for i, w in enumerate(windows):
        same = [j for j, x in enumerate(windows) if x == w]
        assert [j for j in range(len(sets)) if sets[j] == sets[i]] == same
        assert (sets[i] < 0) == (len(same) == 1)


def test_whole_test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(entry.queries()["op5_repeated_text"](spark, sf)) == sorted(brute(rows), key=key)
