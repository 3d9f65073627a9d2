"""Product quantisation of integer vectors with exact arithmetic.

Components become integers, vectors are cut into equal consecutive parts, and every part
position gets a codebook by a few rounds of assignment and averaging. All of it is exact:

* a squared distance is ``|p|^2 - 2 p.b + |b|^2``, and the dot products come from float64 matrix
  products of *limbs*: integers are broken into as many pieces of ``limb_bits`` bits as their
  magnitude needs, so that no sum of products reaches 2^53; the products are recombined in int64;
* the nearest entry is the first minimum of int64 distances, so ties go to the lower index;
* sums are int64 and averages are floors.

Each round is one pass over the vectors: a task holds the codebooks and its own sums, at most one
row per entry leaves it, and Spark adds these up. The driver holds codebooks alone, ``entries`` x
dimension integers. Only the final codes are written, to shared storage, before errors are
summed per label. ``vectors`` is read once per round: give a table, or a staged frame.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; shorter
vectors count as padded with zeros up to the longest length, and that up to a multiple of the
parts; rows without id take part and come after all ids where the first entries are chosen; rows
that repeat an id all take part, the smaller vector first; NULL labels make one group; with fewer
vectors than entries the codebooks have as many entries as there are vectors; an empty table gives
no rows; extra columns are not looked at. Where a squared distance would not fit a bigint the
operator raises, as Spark's ANSI arithmetic does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, stage, table
from tidemark.operators.sizing import fits_broadcast

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Rows whose distances a task holds at once.
CHUNK = 2048


def widest_limb(length: int) -> int:
    """Bits of a limb so that sums of ``length`` products of two limbs stay below 2^53."""
    return (52 - int(length - 1).bit_length()) // 2


def limbs(m: np.ndarray, bits: int) -> list[np.ndarray]:
    """``m`` as pieces of ``bits`` bits, lowest first, the last one signed."""
    pieces, rest = [], m
    while rest.size and max(int(rest.max()), -int(rest.min())) >= 1 << bits:
        pieces.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*pieces, rest.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact where the result fits int64."""
    bits = bits or widest_limb(max(1, a.shape[1]))
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest_entries(points: np.ndarray, book: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest entry, squared distance to it) of every point."""
    own = (book * book).sum(axis=1)
    index, square = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK]
        d = own - 2 * exact_products(part, book, bits)
        first = d.argmin(axis=1)
        index[at : at + CHUNK] = first
        square[at : at + CHUNK] = d[np.arange(len(part)), first] + (part * part).sum(axis=1)
    return index, square


@dataclass(frozen=True)
class Codebooks:
    """One (entries, width) matrix of int64 per part position."""

    books: tuple[np.ndarray, ...]
    scale: int

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    @property
    def fingerprint(self) -> str:
        """SHA-256 of all components in order of part, entry and position."""
        return sha256(",".join(str(int(x)) for b in self.books for x in b.reshape(-1)).encode()).hexdigest()

    def points(self, vectors: pa.Array) -> np.ndarray:
        """The integer vectors of a batch, (rows, parts x width)."""
        return integers(vectors, self.width * len(self.books), self.scale)

    def assign(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per part position: its points, their entries, their squared distances."""
        for k, book in enumerate(self.books):
            part = points[:, k * self.width : (k + 1) * self.width]
            yield part, *nearest_entries(part, book)


def integers(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, rows padded with zeros to ``dim``."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    if (lengths == dim).all():
        return values.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None = None) -> DataFrame:
    """(id, x[, label]): rows whose vector is whole and finite."""
    label = [F.col(label_col).alias("label")] if label_col else []
    picked = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"), *label)
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return picked.where(F.col("x").isNotNull() & finite)


def fit_codebooks(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks | None:
    """The codebooks after all rounds; None where no vector takes part."""
    kept = kept_vectors(vectors, id_col, vector_col)
    most = F.max(F.aggregate("x", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))
    facts = kept.agg(F.max(F.size("x")).alias("dim"), most.alias("most")).first()
    if facts["dim"] is None:
        return None
    width = max(1, -(-facts["dim"] // parts))
    if parts * width * (2 * (scale * facts["most"] + 1)) ** 2 >= 2.0**63:
        raise OverflowError(f"squared distances of components up to {facts['most']} times {scale} do not fit a bigint")
    order = [F.col("id").asc_nulls_last(), whole(F.col("x"), scale)]
    first = kept.orderBy(*order).limit(entries).select(whole(F.col("x"), scale).alias("v")).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for row, r in zip(start, first, strict=True):
        row[: len(r["v"])] = r["v"]
    model = Codebooks(tuple(start[:, k * width : (k + 1) * width].copy() for k in range(parts)), scale)
    for _ in range(rounds):
        model = averaged(kept, model)
    return model


def whole(x: Column, scale: int) -> Column:
    return F.transform(x, lambda c: F.floor(c * scale))


def averaged(kept: DataFrame, model: Codebooks) -> Codebooks:
    """One round: entries become the floors of their parts' averages; unused ones stay."""
    width = model.width
    names = [f"s{i}" for i in range(width)]
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), *((c, pa.int64()) for c in names)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(b.shape, np.int64) for b in model.books]
        count = [np.zeros(len(b), np.int64) for b in model.books]
        for batch in batches:
            for k, (part, entry, _) in enumerate(model.assign(model.points(batch.column(0)))):
                order = entry.argsort(kind="stable")
                used, at = np.unique(entry[order], return_index=True)
                if len(used):
                    total[k][used] += np.add.reduceat(part[order], at, axis=0)
                    count[k] += np.bincount(entry, minlength=len(count[k]))
        for k, n in enumerate(count):
            used = n.nonzero()[0]
            columns = [np.full(len(used), k, np.int32), used.astype(np.int32), n[used], *total[k][used].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=schema)

    ddl = "part int, entry int, n bigint, " + ", ".join(f"{c} bigint" for c in names)
    partial = kept.select("x").mapInArrow(sums, ddl)
    # At most parts x entries rows, whatever the number of vectors.
    rows = partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect()
    books = tuple(b.copy() for b in model.books)
    for r in rows:
        books[r["part"]][r["entry"]] = np.array([r[c] for c in names], np.int64) // r["n"]
    return Codebooks(books, model.scale)


def encode_vectors(
    vectors: DataFrame, model: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, label, codes, error): entries per part and squared distances summed over parts."""
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    types = [f"id {kept.schema['id'].dataType.simpleString()}", f"label {kept.schema['label'].dataType.simpleString()}"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(model.assign(model.points(batch.column(2))))
            codes = np.stack([entry for _, entry, _ in made], axis=1).astype(np.int32)
            at = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
            lists = pa.ListArray.from_arrays(at, pa.array(codes.reshape(-1)))
            error = pa.array(sum(square for _, _, square in made))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, error], names=["id", "label", "codes", "error"])

    ddl = f"{', '.join(types)}, codes array<int>, error bigint"
    if model is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    return kept.select("id", "label", "x").mapInArrow(coded, ddl)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of the same label, NULL labels together.

    Sums are combined before their shuffle. They are broadcast if measured to fit; with more
    labels the join is by label, and adaptive execution splits a hot one.
    """
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = F.broadcast(sums) if fits_broadcast(sums) else sums
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def _sql() -> str:
    """The rounds unrolled, one pair of steps each."""
    out = f"""
    WITH whole AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
        row_number() OVER (ORDER BY vec_id) - 1 AS entry
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT vec_id, label, entry, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS p
      FROM whole, (SELECT unnest(range({PARTS})) AS part)),
    book0 AS MATERIALIZED (SELECT part, entry, p AS b FROM parts WHERE entry < {ENTRIES})"""
    for r in range(ROUNDS + 1):
        out += f""",
    near{r} AS MATERIALIZED (
      SELECT vec_id, label, part, p, min(struct_pack(d := d, entry := entry)) AS best
      FROM (SELECT vec_id, label, part, p, c.entry,
              CAST(list_sum(list_transform(list_zip(p, b), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d
            FROM parts JOIN book{r} AS c USING (part))
      GROUP BY ALL)"""
        if r < ROUNDS:
            out += f""",
    sums{r} AS MATERIALIZED (
      SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS b
      FROM (SELECT part, best.entry AS entry, i, CAST(sum(p[i]) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT part, best, p, unnest(range(1, len(p) + 1)) AS i FROM near{r}) GROUP BY ALL)
      GROUP BY ALL),
    book{r + 1} AS MATERIALIZED (
      SELECT part, entry, coalesce(s.b, o.b) AS b FROM book{r} AS o LEFT JOIN sums{r} AS s USING (part, entry))"""
    return (
        out
        + f""",
    codes AS (
      SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
      FROM near{ROUNDS} GROUP BY ALL),
    print AS (
      SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) AS codebooks_sha256
      FROM (SELECT part, entry, unnest(b) AS x, unnest(range(len(b))) AS i FROM book{ROUNDS}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM codes, print"""
    )


@query("op11_vector_codes", _sql())
def op11_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    model = fit_codebooks(vectors)
    coded = with_label_errors(stage(encode_vectors(vectors, model), "vector-codes"))
    hexed = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select(
        F.col("id").alias("vec_id"),
        hexed.alias("code"),
        "error",
        "label_error",
        F.lit(model.fingerprint if model else None).cast("string").alias("codebooks_sha256"),
    )
