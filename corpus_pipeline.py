"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. Quality: documents scored below one half by the pairwise model go.
2. Near duplicates: of the documents linked by 0.8 of their five-word shingles or more, also
   through others, the one with the smallest id stays.
3. Decontamination: documents that hold a benchmark item go.
4. Personal data: spans in the text are replaced by their kind.
5. Encoding: the pieces of every text that is left, and the text decoded from them.

Every stage works on all that the one before kept, and all but the last return the columns of
the documents. Rows without id are never near duplicates; NULL texts stay NULL up to the last
stage, which encodes them as empty; an empty table passes through.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_copies, personal_data, piece_encoding, quality
from tidemark.llm.common import fresh, ship_code, stage, table

SIMILAR_PERCENT = 80


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = fresh("score", docs.columns)
    scored = quality.score_quality(docs, model, docs.columns, score)
    return scored.where(F.col(score) >= 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop_near_copies(docs, percent=SIMILAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.redact_documents(docs, personal_data.fit_spans(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_documents(docs, piece_encoding.model_proto(), ("n_tokens", "ids", "decoded"))


def shipped(step):
    """A stage that first gives executors this code."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return step(spark, docs, sf_dir)

    return run_step


STAGES = [
    ("quality classifier", shipped(reject_low_quality)),
    ("MinHash near-dedup", shipped(drop_near_duplicates)),
    ("benchmark decontamination", shipped(decontaminate)),
    ("PII", shipped(redact)),
    ("SentencePiece encoding and decoding", shipped(encode)),
]
#: Models and graph components are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
