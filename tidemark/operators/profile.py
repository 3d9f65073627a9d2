"""Table profiles: existence, columns, counts and extremes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.functions.times import time_text
from tidemark.sources import catalog


def columns(spark: SparkSession, name: str) -> list[str] | None:
    table = catalog.read(spark, name)
    return None if table is None else table.columns


def column_types(spark: SparkSession, name: str) -> dict[str, str] | None:
    table = catalog.read(spark, name)
    return None if table is None else dict(table.dtypes)


def schema(spark: SparkSession, name: str) -> StructType | None:
    table = catalog.read(spark, name)
    return None if table is None else table.schema


def row_count(spark: SparkSession, name: str) -> int:
    table = catalog.read(spark, name)
    return 0 if table is None else table.count()


def distinct_count(spark: SparkSession, name: str, column: str) -> int:
    table = catalog.read(spark, name)
    if table is None or column not in table.columns:
        return 0
    return table.agg(F.count_distinct(column)).first()[0]


def extreme(spark: SparkSession, name: str, column: str, which: Literal["min", "max"], as_text: bool = True):
    """Smallest or largest value; None without table, column or rows.

    Dates and timestamps come as text unless the raw value is asked for.
    """
    table = catalog.read(spark, name)
    if which not in ("min", "max"):
        raise ValueError("ask for 'min' or 'max'")
    if table is None or column not in table.columns:
        return None
    return table.agg(extreme_of(table, column, which, as_text)).first()[0]


def extreme_of(df: DataFrame, column: str, which: Literal["min", "max"], as_text: bool = True) -> Column:
    value = F.min(column) if which == "min" else F.max(column)
    kind = df.schema[column].dataType
    if as_text and isinstance(kind, DateType):
        value = value.cast("string")
    elif as_text and isinstance(kind, (TimestampType, TimestampNTZType)):
        value = time_text(value)
    return value


def freshness(snapshots: DataFrame, column: str = "dt") -> DataFrame:
    """Latest snapshot date as text, in one row."""
    return snapshots.agg(extreme_of(snapshots, column, "max").alias("last_update"))


def column_profile(df: DataFrame, columns: list[str], distinct: list[str] = ()) -> DataFrame:
    """Row count, extremes as text and exact distinct counts, in one row.

    Counts and extremes share one pass. Every distinct count multiplies the shuffled
    rows, so only the columns named in ``distinct`` get one.
    """
    aggregates = [F.count("*").alias("row_count")]
    for c in columns:
        aggregates.append(extreme_of(df, c, "min").cast("string").alias(f"min_{c}"))
        aggregates.append(extreme_of(df, c, "max").cast("string").alias(f"max_{c}"))
    aggregates += [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct]
    return df.agg(*aggregates)


def table_profile(spark: SparkSession, name: str) -> DataFrame:
    """One row: name, database, table, whether it exists, columns, types, row count."""
    database, table = catalog.split_name(spark, name)
    data = catalog.read(spark, name)
    if data is None:
        base = spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"))
        names, types = F.lit(None).cast("array<string>"), F.lit(None).cast("map<string,string>")
    else:
        base = data.agg(F.count("*").alias("row_count"))
        names = F.array(*[F.lit(c) for c in data.columns])
        types = F.create_map(*[F.lit(x) for pair in data.dtypes for x in pair])
    return base.select(
        F.lit(name).alias("name"),
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        F.lit(data is not None).alias("exists"),
        names.alias("columns"),
        types.alias("column_types"),
        "row_count",
    )


def require_rows(df: DataFrame) -> DataFrame:
    """The data itself; having no rows is an error."""
    if df.isEmpty():
        raise ValueError("the query returns no rows")
    return df


# Types whose extremes a file's footer keeps exactly and Spark reads from there. Those of floating-point
# numbers leave out NaN and the sign of zero.
FOOTER_TYPES = (BooleanType, ByteType, ShortType, IntegerType, LongType, DateType)


def footer_profile(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """Row count and extremes as text, as ``column_profile`` gives them, from file footers.

    Counts, and extremes of integers and dates, are read from the footers of the table's files;
    those of partition columns from the list of partitions. Text, whose statistics may be
    cut short, and the other types are scanned, and so is everything where a file has no statistics.
    """
    table = catalog.read(spark, name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    stored = [c for c in columns if c not in parts and isinstance(table.schema[c].dataType, FOOTER_TYPES)]
    values = _footer_values(spark, name, stored)
    if values is None:
        return column_profile(table, columns)
    found = dict(zip(_profile_names(stored), values, strict=True))
    scanned = [c for c in columns if c not in parts and c not in stored]
    if scanned:
        found |= column_profile(table, scanned).drop("row_count").first().asDict()
    for c in set(columns) & set(parts):
        found |= partition_extremes(spark, name, c, table.schema[c].dataType).first().asDict()
    wanted = _profile_names(columns)
    ddl = ", ".join(f"`{n}` {'bigint' if n == 'row_count' else 'string'}" for n in wanted)
    return spark.createDataFrame([tuple(found[n] for n in wanted)], ddl)


def _profile_names(columns: list[str]) -> list[str]:
    return ["row_count", *(f"{which}_{c}" for c in columns for which in ("min", "max"))]


def footer_frame(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """The aggregate over the table's files whose plan takes everything from footers.

    Only valid while ``_footers_only`` holds: it is what lets Spark push the aggregate down.
    """
    # Footers are looked up by a column's place in the file, so the schema is that of the whole file.
    parts = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    whole = StructType([f for f in spark.table(name).schema.fields if f.name not in parts])
    files = spark.read.schema(whole).parquet(catalog.location(spark, name))
    aggregates = [F.count("*").alias("row_count")]
    aggregates += [f(c).alias(f"{which}_{c}") for c in columns for which, f in (("min", F.min), ("max", F.max))]
    return files.agg(*aggregates)


@contextmanager
def _footers_only(spark: SparkSession) -> Iterator[None]:
    """Session settings under which Spark answers plain aggregates from Parquet footers."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _footer_values(spark: SparkSession, name: str, columns: list[str]) -> tuple | None:
    """Count and extremes as text; None where a file lacks statistics, or the plan would scan."""
    with _footers_only(spark):
        frame = footer_frame(spark, name, columns)
        text = frame.select(*[frame[c] if c == "row_count" else frame[c].cast("string").alias(c) for c in frame.columns])
        if "PushedAggregation: [COUNT(*)" not in text._jdf.queryExecution().executedPlan().toString():
            return None
        try:
            count, *extremes = text.first()
            return (count or 0, *extremes)  # the sum over no file at all is NULL
        except Exception as error:  # a file whose footer has no statistics for a column
            if "FAILED_READ_FILE" not in str(error) and "statistics" not in str(error):
                raise
            return None  # and a file that cannot be read at all fails the scan, too


def partition_extremes(spark: SparkSession, name: str, column: str, kind: DataType) -> DataFrame:
    """Extremes of a partition column, as text, from the catalog's list of partitions: no file is opened."""
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    typed = F.when(value != "__HIVE_DEFAULT_PARTITION__", value).try_cast(kind)
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(typed.alias(column))
    return listed.agg(*[extreme_of(listed, column, w).cast("string").alias(f"{w}_{column}") for w in ("min", "max")])


# A bitmap of Spark's covers so many values, in so many bytes.
BITMAP_VALUES, BITMAP_BYTES = 32_768, 4_096


def column_bitmaps(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, column, bucket, bitmap): which integers occur, for all columns in one pass.

    Bitmaps of tasks are combined before the shuffle, and those of days or partitions can be
    kept and combined later (``distinct_of_bitmaps``). Dates count as their day numbers.
    """
    values = [F.struct(F.lit(c).alias("column"), _as_number(df, c).alias("value")) for c in columns]
    rows = df.select(*by, F.explode(F.array(*values)).alias("v")).select(*by, "v.column", "v.value").filter("value is not null")
    bucket = F.bitmap_bucket_number("value").alias("bucket")
    return rows.groupBy(*by, "column", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap"))


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"{column} is {kind.simpleString()}, not an integer or a date")
    return F.col(column).cast("bigint")


def distinct_of_bitmaps(bitmaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, column, distinct_count) from bitmaps of any number of passes, days or partitions."""
    whole = bitmaps.groupBy(*by, "column", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return whole.groupBy(*by, "column").agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias("distinct_count"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, distinct_count) of integer and date columns, exactly, one row per column.

    Columns whose values lie close enough to each other go through bitmaps, all in one pass. One with
    few values over a wide range would need a bitmap for nearly each; such columns
    are counted by their distinct values, which combine before their shuffle.
    """
    spans = [f(_as_number(df, c)).alias(f"{w}_{c}") for c in columns for w, f in (("min", F.min), ("max", F.max))]
    facts = df.agg(F.count("*").alias("n"), *spans).first()

    def is_dense(c: str) -> bool:
        low, high = facts[f"min_{c}"], facts[f"max_{c}"]
        return low is None or ((high - low) // BITMAP_VALUES + 1) * BITMAP_BYTES <= 16 * facts["n"] + BITMAP_BYTES

    dense = [c for c in columns if is_dense(c)]
    out = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    found = distinct_of_bitmaps(column_bitmaps(df, dense)) if dense else None
    for c in columns:
        if c not in dense:
            one = df.select(_as_number(df, c).alias("v")).filter("v is not null").distinct()
            one = one.agg(F.count("*").alias("distinct_count")).select(F.lit(c).alias("column"), "distinct_count")
            found = one if found is None else found.unionByName(one)
    return out.join(found, "column", "left").select("column", F.coalesce("distinct_count", F.lit(0).cast("bigint")).alias("distinct_count"))
