"""Exact top-k inner products over a pivot-distance index.

Vectors get one more component that brings all to the same length, so that a larger inner
product with a query is a smaller distance to it. Every vector belongs to its nearest pivot
and, by its distance to the pivot, to a ring around it. By the triangle inequality a query at
distance d from a pivot is no nearer than ``|d - r|`` to any vector at distance r, which bounds
the inner products within a ring.

The search takes the rings of each query in order of that bound, twice: first as many as hold
k candidates (and ``OPENING``), which gives a score that the k-th best cannot fall below; then all further rings
whose bound reaches that score. Both are exact scans of the ring by matrix products.

Pivots are a sample of bounded size (``PIVOTS`` vectors with the smallest hashed ids); all
vectors are indexed. The driver holds only pivots and rings: their number is bounded by
``PIVOTS`` times the rings a radius can have, whatever the number of vectors. A ring with many
vectors (or copies of one) is cut into chunks by hashed id, and queries travel to the rings'
chunks in blocks.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows without
id, take no part; a shorter vector counts as padded with zeros; rows that repeat an id are
queries and candidates of their own, and only a query's own row is none of its candidates; equal
scores go to the smaller id; fewer than k others give fewer rows; an empty table gives none; extra
columns are not looked at. Products beyond 2^52 are computed exactly from limbs; where a product
could pass 2^62 the operator raises, as Spark's ANSI arithmetic does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, stage, table
from tidemark.llm.vector_codes import exact_products

PIVOTS = 64
RINGS = 48
CHUNK = 4096
BLOCK = 512
#: Room for rounding in distances, in units of the bound on an inner product.
SLACK = 1e-6
#: Candidates that the first scan of a query covers at least: more of them raise the score to beat.
OPENING = 1024


class Pivots:
    """Pivots with the extra component, and the squared length that all vectors share."""

    def __init__(self, rows: list[list[int]], dim: int, longest: float):
        self.dim, self.longest = dim, longest
        self.points = self.raised(padded(rows, dim))
        self.width = max(1.0, 2 * np.sqrt(longest) / RINGS)

    def raised(self, m: np.ndarray) -> np.ndarray:
        rest = self.longest - (m * m).sum(axis=1)
        return np.hstack([m, np.sqrt(np.maximum(rest, 0))[:, None]])

    def distances(self, raised: np.ndarray) -> np.ndarray:
        square = (raised**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1) - 2 * raised @ self.points.T
        return np.sqrt(np.maximum(square, 0))


def padded(rows: list, dim: int, kind: type = float) -> np.ndarray:
    m = np.zeros((len(rows), dim), kind)
    for i, r in enumerate(rows):
        m[i, : len(r)] = r
    return m


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, id, v): a number of its own for every row, components as floor(scale * x)."""
    finite = F.forall(F.col("x"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Beyond any product that is allowed: such values are told by `longest` and never multiplied.
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(2.0**62)), F.lit(-(2.0**62))))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
        .where(F.col("id").isNotNull() & F.col("x").isNotNull())
        .where(finite)
        .select(F.monotonically_increasing_id().alias("row"), "id", F.transform("x", whole).alias("v"))
    )


def keyed(vectors: DataFrame, pivots: Pivots) -> DataFrame:
    """(row, id, v, pivot, ring, r): every vector under its nearest pivot."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raised = pivots.raised(padded(batch.column(2).to_pylist(), pivots.dim))
            d = pivots.distances(raised)
            nearest = d.argmin(axis=1)
            r = d[np.arange(len(d)), nearest]
            made = [pa.array(nearest, pa.int32()), pa.array(r // pivots.width, pa.int32()), pa.array(r, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=["row", "id", "v", "pivot", "ring", "r"])

    return vectors.mapInArrow(assign, "row bigint, id bigint, v array<bigint>, pivot int, ring int, r double")


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256):
    """(pivots, rows keyed by ring in shared storage, rings on the driver)."""
    usable = stage(usable_vectors(vectors, id_col, vector_col, scale), "pivot-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = usable.agg(F.max(F.size("v")).alias("dim"), F.max(square).alias("longest")).first()
    dim, longest = facts["dim"] or 0, facts["longest"] or 0.0
    if longest >= 2.0**62:
        raise OverflowError("products of vectors that long do not fit a bigint")
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    pivots = Pivots([r["v"] for r in sample], dim, longest)
    rows = stage(keyed(usable, pivots), "pivot-rows") if sample else None
    rings = [] if rows is None else rows.groupBy("pivot", "ring").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n")).collect()
    return pivots, rows, sorted(rings, key=lambda r: (r["pivot"], r["ring"]))


def ring_bounds(q: np.ndarray, pivots: Pivots, rings: list) -> np.ndarray:
    """Upper bounds of the inner products of each query with the vectors of each ring."""
    raised = np.hstack([q, np.zeros((len(q), 1))])
    d = pivots.distances(raised)[:, [r["pivot"] for r in rings]]
    low, high = (np.array([r[k] for r in rings]) for k in ("low", "high"))
    gap = np.maximum(np.maximum(d - high, low - d), 0)
    square = (q * q).sum(axis=1)[:, None] + pivots.longest
    return (square - gap**2) / 2 + SLACK * (square + 1)


def _visits(queries: DataFrame, pivots: Pivots, rings: list, k: int, first: bool) -> DataFrame:
    """Queries dealt to rings in blocks: those that hold the best k by bound, or all others in reach."""
    counts = np.array([r["n"] for r in rings])
    opened = max(k, OPENING)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = np.array(part.column(0).to_pylist(), np.int64)
                q = padded(part.column(1).to_pylist(), pivots.dim)
                least = np.array(part.column(2).to_pylist(), float)
                bound = ring_bounds(q, pivots, rings)
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.cumsum(counts[order], axis=1) - counts[order]
                opening = np.zeros_like(bound, bool)
                np.put_along_axis(opening, order, before <= opened, axis=1)
                wanted = opening if first else ~opening & (bound >= least[:, None])
                out = {c: [] for c in ("pivot", "ring", "ids", "q", "least")}
                for j in np.flatnonzero(wanted.any(axis=0)):
                    rows = np.flatnonzero(wanted[:, j])
                    out["pivot"].append(rings[j]["pivot"])
                    out["ring"].append(rings[j]["ring"])
                    out["ids"].append(ids[rows].tobytes())
                    out["q"].append(q[rows].astype(np.int64).tobytes())
                    out["least"].append(least[rows].tobytes())
                yield pa.RecordBatch.from_pydict(out, VISIT)

    return queries.mapInArrow(deal, "pivot int, ring int, ids binary, q binary, least binary")


VISIT = pa.schema([("pivot", pa.int32()), ("ring", pa.int32()), ("ids", pa.binary()), ("q", pa.binary()), ("least", pa.binary())])
CHUNKED = pa.schema([("pivot", pa.int32()), ("ring", pa.int32()), ("rows", pa.binary()), ("members", pa.binary()), ("m", pa.binary())])


def _chunks(rows: DataFrame, dim: int) -> DataFrame:
    """The rows of a ring packed into matrices of at most CHUNK vectors, in order of their ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, ring = (np.array(batch.column(i).to_pylist(), np.int32) for i in (3, 4))
            row, ids = (np.array(batch.column(i).to_pylist(), np.int64) for i in (0, 1))
            m = padded(batch.column(2).to_pylist(), dim, np.int64)
            order = np.lexsort((ids, ring, pivot))
            cuts = np.flatnonzero(np.diff(pivot[order]) | np.diff(ring[order])) + 1
            out = {c: [] for c in CHUNKED.names}
            for group in np.split(order, cuts):
                for at in range(0, len(group), CHUNK):
                    part = group[at : at + CHUNK]
                    out["pivot"].append(int(pivot[part[0]]))
                    out["ring"].append(int(ring[part[0]]))
                    out["rows"].append(row[part].tobytes())
                    out["members"].append(ids[part].tobytes())
                    out["m"].append(m[part].tobytes())
            yield pa.RecordBatch.from_pydict(out, CHUNKED)

    return rows.select("row", "id", "v", "pivot", "ring").mapInArrow(pack, "pivot int, ring int, rows binary, members binary, m binary")


def _scan(visits: DataFrame, chunks: DataFrame, dim: int, longest: float, k: int) -> DataFrame:
    """(query, vec_id, score): per query row and chunk the best k, if they reach its least score."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, rows, members = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "members"))
                q = np.frombuffer(row["q"], np.int64).reshape(len(own), dim)
                m = np.frombuffer(row["m"], np.int64).reshape(len(members), dim)
                # No sum of products passes the greatest squared length.
                score = (q.astype(float) @ m.T.astype(float)).astype(np.int64) if longest < 2.0**52 else exact_products(q, m)
                taken = (own[:, None] != rows) & (score >= np.frombuffer(row["least"])[:, None])
                if len(members) > 4 * k:
                    kth = -np.partition(np.where(taken, -score, np.iinfo(np.int64).max), k - 1, axis=1)[:, k - 1]
                    taken &= score >= kth[:, None]
                i, j = np.nonzero(taken)
                order = np.lexsort((members[j], -score[i, j], i))
                i, j = i[order], j[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[place < k], j[place < k]
                made = [pa.array(own[i]), pa.array(members[j]), pa.array(score[i, j])]
                yield pa.RecordBatch.from_arrays(made, names=["query", "vec_id", "score"])

    pairs = visits.join(chunks, ["pivot", "ring"]).drop("pivot", "ring")
    return pairs.mapInArrow(scan, "query bigint, vec_id bigint, score bigint")


def top_products(
    vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """The k largest inner products of every query row with all other rows.

    ``is_query`` is a condition on ``id`` that marks the query rows.
    """
    spark = vectors.sparkSession
    pivots, rows, rings = build_index(vectors, id_col, vector_col, scale)
    if rows is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    asked = rows.where(is_query)
    queries = asked.select("row", "v")
    # Rows of a ring meet in tasks of their own; hashed row numbers cut a ring too large for one.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(max(1, sum(r["n"] for r in rings) // CHUNK))))
    chunks = stage(_chunks(salted.repartition("salt"), pivots.dim), "pivot-chunks")
    lowest = float("-inf")
    opening = _scan(_visits(queries.withColumn("least", F.lit(lowest)), pivots, rings, k, True), chunks, pivots.dim, pivots.longest, k)
    opening = stage(_best(opening, k), "pivot-opening")
    least = opening.groupBy(F.col("query").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("s"))
    least = least.select("row", F.when(F.col("n") >= k, F.col("s").cast("double")).otherwise(F.lit(lowest)).alias("least"))
    later = queries.join(least, "row", "left").select("row", "v", F.coalesce("least", F.lit(lowest)).alias("least"))
    rest = _scan(_visits(later, pivots, rings, k, False), chunks, pivots.dim, pivots.longest, k)
    best = _best(opening.select("query", "vec_id", "score").unionByName(rest), k)
    named = asked.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return best.join(named, "query").select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query", "rank", "vec_id", "score")


@query("op10_pivot_search")
def op10_pivot_search(spark, sf_dir):
    return top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
