"""Landed files as a stream: each micro-batch is merged into its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import MergeSpec
from tidemark.operators.sizing import any_null
from tidemark.sources import catalog


def newest_per_key(rows: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """One row per key, the one with the greatest ``version``.

    A batch may hold several landings of one record. Copies are combined before the
    shuffle, so a key with very many of them is not gathered. A NULL key matches nothing,
    so rows with one are all kept.
    """
    own = F.when(any_null(keys), F.monotonically_increasing_id())
    hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    rank = F.struct(F.col(version), F.xxhash64(*hashable))
    marked = rows.withColumns({f"_k_{k}": F.col(k) for k in keys} | {"_own": own})
    newest = marked.groupBy(*[f"_k_{k}" for k in keys], "_own").agg(
        F.max_by(F.struct(*rows.columns), rank).alias("row")
    )
    return newest.select("row.*")


def merge_stream(
    spark: SparkSession,
    path: str,
    ddl: str,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    spec: MergeSpec,
    version: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
):
    """Merge all files not seen before, then stop; returns the finished query.

    ``checkpoint`` remembers which files were taken in. A batch repeated after a failure
    changes nothing, because the merge policies are idempotent.
    """

    def merge_batch(batch: DataFrame, _: int) -> None:
        catalog.merge_into(newest_per_key(transform(batch), spec.keys, version), table, spec)

    query = (
        spark.readStream.schema(ddl)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one may have an older version in mind.
    if catalog.exists(spark, table):
        spark.catalog.refreshTable(table)
    return query
