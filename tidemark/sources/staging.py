"""Staged data: a DataFrame written once to the shared scratch folder and read back."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import remove_path, scratch_path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Freeze ``df``: later passes see the same rows, and its lineage ends here."""
    return _written(df, scratch_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for the length of a block; the files are removed at its end."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _written(df, path)
    finally:
        remove_path(df.sparkSession, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over DataFrames named in braces, without global view names.

    ``sql_over(spark, "select count(*) from {orders}", orders=df)``
    """
    return spark.sql(query, **frames)


def register(df: DataFrame, name: str) -> None:
    """Give ``df`` a view name for plain SQL text."""
    df.createOrReplaceTempView(name)
