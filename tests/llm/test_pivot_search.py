import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.llm.pivot_search import top_products


def brute(rows, is_query, k=5, scale=256):
    """Every row against every other row; rows that repeat an id are rows of their own."""
    whole = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in whole]
    out = []
    for at, (i, q) in enumerate(kept):
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for n, (j, v) in enumerate(kept) if n != at)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = entry.queries()["op10_pivot_search"](spark, "/root/testdata/sf0.01")
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert found(got) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("dim, spread", [(2, 3.0), (8, 0.4)])
def test_clustered_vectors(spark, dim, spread):
    rng = random.Random(dim)
    rows = []
    for i in range(600):
        centre = rng.choice([-spread, 0, spread])
        rows.append((i, [round(centre + rng.gauss(0, 0.1), 2) for _ in range(dim)]))
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # copies: ties by id
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found(top_products(df, F.col("id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (50, [0.1]), (51, []), (52, None), (53, [float("nan"), 1.0]), (54, [float("inf")]), (55, [None, 1.0]), (None, [1.0]), (0, [1.0, 0.5]), (0, [2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as id", "2 as pivot", "3 as v")
    assert found(top_products(df, F.col("id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)
    assert top_products(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert top_products(df.where("vec_id = 50"), F.col("id") % 50 == 0).count() == 0


def test_rows_that_repeat_an_id(spark):
    rng = random.Random(1)
    rows = [(i % 40, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)] + [(0, [3.0] * 4)] * 7
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found(top_products(df, F.col("id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [round(rng.gauss(0, 1) * 10**6, 2) for _ in range(3)]) for i in range(120)]
    rows += [(500 + i, [1e6 + i, 0.0, -1e6]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found(top_products(df, F.col("id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)
    for huge in (1e30, -1e300):
        with pytest.raises(OverflowError, match="do not fit a bigint"):
            top_products(spark.createDataFrame([(0, [huge]), (1, [1.0])], "vec_id bigint, embedding array<double>"), F.col("id") == 0)
