"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from hashlib import sha256
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rows that Spark hands to Python at once where the session does not say: whole texts are long, and their
#: buffers are held on both sides by every task.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

#: Words are runs of anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with its SQL where SQL can express it."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def ship_code(spark: SparkSession) -> None:
    """Give executors this package, which need not be installed where they run, in batches of bounded rows."""
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for f in sorted(package.rglob("*.py")):
            # A fixed date, so that the same code always is the same archive.
            entry = zipfile.ZipInfo(f.relative_to(package.parent).as_posix(), (2000, 1, 1, 0, 0, 0))
            archive.writestr(entry, f.read_bytes())
    name = f"{package.name}-{sha256(data.getvalue()).hexdigest()[:16]}.zip"
    context = spark.sparkContext
    if any(f.endswith(name) for f in context.listFiles):
        return
    path = Path(tempfile.mkdtemp()) / name
    path.write_bytes(data.getvalue())
    context.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_remainder(name: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; NULL ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % mod


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Every byte of ASCII white space becomes a blank, so that ``split(b" ")`` sees only blanks.
BLANK_BYTES = bytes(32 if 9 <= c <= 13 else LOWER_BYTES[c] for c in range(256))


def lower_words(text: str) -> list[bytes]:
    """Lower-cased words of a text as UTF-8."""
    return [w for w in text.encode("utf-8", "surrogatepass").translate(BLANK_BYTES).split(b" ") if w]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no input column has."""
    return name if name not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 2000):
    """A ``mapInArrow`` function that applies ``fn`` to slices of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))
        # Workers live on: what Arrow's pool keeps for later would count against the tasks that follow.
        pa.default_memory_pool().release_unused()

    return run
