"""Measured sizes: what may be broadcast, and which partitions a job has to touch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

BROADCAST_BYTES = 64 << 20
# Partition values that may travel through the driver as a literal filter.
LITERAL_PARTITIONS = 500


def row_bytes(schema: StructType) -> Column:
    """An upper bound of a row's size in memory.

    Fixed-width fields take a word each and text its bytes; nested fields are measured
    by twice their JSON text, which names every field it holds.
    """
    total = F.lit(_fixed_bytes(schema)).cast("bigint")
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            text = F.octet_length(F.to_json(F.struct(value)))
            total = total + 2 * text + 16 * f.dataType.simpleString().count(":")
    return total


def _fixed_bytes(schema: StructType) -> int:
    return 16 * (len(schema.fields) + 2)


def measured(df: DataFrame) -> int:
    """Upper bound of the data's size in memory, from one pass over it."""
    return df.agg(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, rows: int | None = None) -> bool:
    """Whether the data is proven to take no more than ``limit`` bytes in memory.

    Data with too many rows to fit is told by their count alone, given as ``rows`` if it is
    known already, so that only data that may be small is measured.
    """
    if limit <= 0 or (df.count() if rows is None else rows) * _fixed_bytes(df.schema) > limit:
        return False
    return measured(df) <= limit


def any_null(columns: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def same_partition(left: str, right: str, columns: tuple[str, ...]) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
    )


def listed_partitions(
    rows: DataFrame, columns: tuple[str, ...], limit: int = LITERAL_PARTITIONS
) -> list[Row] | None:
    """The distinct partitions of ``rows``, or None if there are more than ``limit``."""
    listed = rows.select(*columns).distinct().limit(limit + 1).collect()
    return listed if len(listed) <= limit else None


def only_partitions(df: DataFrame, touched: DataFrame | list[Row], columns: tuple[str, ...]) -> DataFrame:
    """Rows of ``df`` in the partitions given as a list or as the rows of a DataFrame.

    A list becomes a literal filter, so the scan opens only those folders; a DataFrame
    is for longer lists and becomes a semi join, which keeps them off the driver.
    """
    if isinstance(touched, DataFrame):
        values = touched.select(*columns).distinct()
        if fits_broadcast(values):
            values = F.broadcast(values)
        return df.alias("d").join(values.alias("v"), same_partition("d", "v", columns), "left_semi")
    if not touched:
        return df.limit(0)
    if len(columns) == 1:
        (c,) = columns
        values = [row[c] for row in touched]
        term = F.col(c).isin([v for v in values if v is not None])
        return df.filter(term | F.col(c).isNull() if None in values else term)
    terms = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in touched]
    return df.filter(reduce(lambda a, b: a | b, terms))
