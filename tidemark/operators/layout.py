"""Clustered layout: rows written in order of several columns."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import catalog

TARGET_FILE_BYTES = 256 << 20
_TIE = "_tie"


def clustered(df: DataFrame, columns: list[str], files: int, leading: tuple[str, ...] = ()) -> DataFrame:
    """``df`` range-partitioned by the columns into ``files`` parts, each sorted by them.

    Spark cuts the ranges at quantiles of a sample that it takes for itself. Equal values may go to
    several files: a tie column spreads them, so that a value held by a large share of the
    rows does not end up in one task. Files can be pruned by the first column, and by the next
    ones where those before them are equal.
    """
    if _TIE not in df.columns:
        hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        df = df.withColumn(_TIE, F.xxhash64(*hashable))
    return df.repartitionByRange(files, *leading, *columns, _TIE).sortWithinPartitions(*leading, *columns).drop(_TIE)


def cluster_table(
    spark: SparkSession, name: str, columns: list[str], target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Rewrite a table clustered by several columns; returns its layout before and after."""
    table = catalog.read(spark, name)
    if table is None:
        raise ValueError(f"there is no table {name}")
    absent = [c for c in columns if c not in table.columns]
    if absent or not columns:
        raise ValueError(f"cannot cluster {name} by {columns}; missing: {absent}")
    before = layout_summary(table).first()
    files = max(1, ceil(before["bytes"] / target_bytes))
    # A row's place in its file tells identical rows apart.
    rows = table.withColumn(_TIE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    parts = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    result = clustered(rows, columns, files, leading=parts)
    if parts:
        catalog.replace_partitions(result, name)
    else:
        catalog.publish(result, name)
    after = layout_summary(spark.table(name))
    return after.select(
        F.lit(name).alias("table"),
        F.lit(before["files"]).alias("files_before"),
        F.lit(before["bytes"]).alias("bytes_before"),
        F.col("files").alias("files_after"),
        F.col("bytes").alias("bytes_after"),
        F.col("rows").alias("rows"),
    )


def file_layout(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per file: rows, bytes, and each clustering column's range."""
    files = table.select("_metadata.file_path", "_metadata.file_size", *columns)
    return files.groupBy("file_path").agg(
        F.count("*").alias("rows"),
        F.max("file_size").alias("bytes"),
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
    )


def layout_summary(table: DataFrame) -> DataFrame:
    """Files, bytes and rows of a table, from file metadata."""
    return file_layout(table, []).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
    )
