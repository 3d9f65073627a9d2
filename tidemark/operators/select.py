"""Column selection, unions and record padding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def select_ordered(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """The named columns in the order given, and the names of those left out."""
    if not columns:
        raise ValueError("name at least one column")
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"the data has no columns {absent}")
    return df.select(*columns), [c for c in df.columns if c not in columns]


def select_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c.startswith(prefix)])


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order."""
    return df.select(*sorted(df.columns))


def pad_union(frames: list[DataFrame]) -> DataFrame:
    """All rows over the union of the frames' columns; missing ones are NULL."""
    padded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return sorted_columns(padded)


def stack_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    """UNION ALL by position, keeping the first frame's names."""
    return first.union(second)


def sample_rows(df: DataFrame, key: str, n: int = 3, seed: int = 0, groups: tuple[str, ...] = ()) -> DataFrame:
    """``n`` rows picked by a hash of their key, of each group if there are ``groups``: the
    same ones on every run.

    Each task keeps its own best ``n`` (of every group), so nothing but candidates is shuffled.
    """
    lot = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    if not groups:
        return df.orderBy(lot, key).limit(n)
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(lot, key))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
