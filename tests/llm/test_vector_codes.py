import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from tidemark.llm.vector_codes import encode_vectors, exact_products, fit_codebooks, limbs, nearest_entries, widest_limb, with_label_errors


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Codes, errors and codebooks with Python integers alone."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    cut = [(i, [tuple((v + [0] * (parts * width))[k * width : (k + 1) * width]) for k in range(parts)], label) for i, v, label in kept]
    cut.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[p[k] for _, p, _ in cut[:entries]] for k in range(parts)]

    def best(p, book):
        return min((sum((x - y) ** 2 for x, y in zip(p, b, strict=True)), j) for j, b in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            met = defaultdict(list)
            for _, p, _ in cut:
                met[best(p[k], books[k])[1]].append(p[k])
            books[k] = [tuple(sum(c) // len(met[j]) for c in zip(*met[j], strict=True)) if j in met else b for j, b in enumerate(books[k])]
    out = []
    for i, p, label in cut:
        found = [best(p[k], books[k]) for k in range(parts)]
        out.append((i, tuple(j for _, j in found), sum(d for d, _ in found), label))
    by_label = defaultdict(int)
    for _, _, error, label in out:
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for b in book for x in b).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label]) for i, code, error, label in out), key=str), digest


def quantised(df, **how):
    model = fit_codebooks(df, **how)
    rows = with_label_errors(encode_vectors(df, model)).collect()
    return sorted(((r["id"], tuple(r["codes"]), r["error"], r["label_error"]) for r in rows), key=str), model


def test_limbs_give_exact_products():
    rng = np.random.default_rng(3)
    for bits, top in [(None, 1 << 10), (None, 1 << 28), (3, 1 << 12), (1, 5), (24, 1 << 27)]:
        a, b = rng.integers(-top, top, (40, 16)), rng.integers(-top, top, (9, 16))
        assert (exact_products(a, b, bits) == a @ b.T).all()
    assert all((sum(p.astype(np.int64) << (4 * k) for k, p in enumerate(limbs(m, 4))) == m).all() for m in [np.array([[-17, 0, 300], [5, -1, -4096]])])
    for n in (1, 2, 3, 16, 64, 1000):
        assert n * ((1 << widest_limb(n)) - 1) ** 2 < 1 << 53


def test_float64_alone_would_be_wrong():
    # Two entries whose distances differ by one beyond 2^53.
    p = np.array([[1 << 28, 3]])
    book = np.array([[-(1 << 28), 5], [-(1 << 28), 4]])
    index, square = nearest_entries(p, book)
    assert index.tolist() == [1] and square.tolist() == [(1 << 58) + 1]
    assert float((1 << 58) + 1) == float((1 << 58) + 4)


def test_ties_go_to_the_lower_entry():
    index, square = nearest_entries(np.array([[0], [2], [1]]), np.array([[2], [0], [2], [0]]), bits=1)
    assert index.tolist() == [1, 0, 0] and square.tolist() == [0, 0, 1]


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(entry.queries()["op11_vector_codes"](spark, sf), duck(sf), entry.oracle_sql()["op11_vector_codes"]) is None


def test_whole_test_table(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    expected, digest = brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    got = entry.queries()["op11_vector_codes"](spark, sf)
    assert got.dtypes == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    assert sorted((r.vec_id, tuple(bytes.fromhex(r.code)), r.error, r.label_error) for r in got.collect()) == sorted(expected)
    assert {r.codebooks_sha256 for r in got.select("codebooks_sha256").distinct().collect()} == {digest}


@pytest.mark.parametrize("tasks", [1, 7])
def test_odd_rows(spark, tasks):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], rng.choice([0, 1, None])) for i in range(60)]
    rows += [(100 + i, rows[0][1], 0) for i in range(60)]  # copies
    rows += [(3, rows[4][1], None), (3, [-70_000.0, 1e-9], 1), (None, [2.5], 1), (None, [], None), (7, None, 1)]
    rows += [(8, [float("nan"), 1.0], 0), (9, [1.0, float("-inf")], 0), (10, [None, 1.0], 0), (11, [-0.1, 70_000.5, 3.0], 0)]
    # The extra columns carry names of the operator's own.
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    df = df.selectExpr("*", "1 as id", "2 as x", "3 as error", "4 as codes", "5 as `of`").repartition(tasks)
    for entries in (1, 5, 256):
        expected, digest = brute(rows, entries=entries)
        got, model = quantised(df, entries=entries)
        assert got == expected and model.fingerprint == digest


def test_empty_and_too_large(spark):
    ddl = "vec_id bigint, embedding array<float>, label int"
    empty = spark.createDataFrame([(1, None, 2)], ddl)
    assert quantised(empty) == ([], None)
    assert quantised(empty.limit(0)) == ([], None)
    with pytest.raises(OverflowError, match="do not fit a bigint"):
        fit_codebooks(spark.createDataFrame([(1, [1e30], 2)], ddl))


def test_many_labels_need_no_broadcast(spark, monkeypatch):
    from tidemark.llm import vector_codes

    monkeypatch.setattr(vector_codes, "fits_broadcast", lambda df: False)
    rows = [(i, [float(i % 7), 0.3, 0.2, i / 50], None if i % 3 else i) for i in range(50)]
    got, _ = quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert got == brute(rows)[0]
