"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name or the one given, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become texts that are made and parsed: dealt to all cores, whatever the file's layout.

    One task reads a whole row group, which may hold a million narrow rows. Adaptive execution
    would put such rows back into few tasks by their bytes, so their number is given.
    """
    return table(spark, sf_dir, name).repartition(2 * spark.sparkContext.defaultParallelism)


def scratch_database(spark) -> str:
    """A database of its own for one query's tables, kept in the scratch folder."""
    name = f"tidemark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name
