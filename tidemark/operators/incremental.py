"""Loading only what changed: high-water marks, filters on them, rejects."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import EPOCH, is_malformed_time, to_day
from tidemark.operators.select import sample_rows

Mode = Literal["new", "all", "sample"]


def high_water_marks(table: DataFrame, groups: tuple[str, ...], field: str) -> DataFrame:
    """Latest ``field`` of each group, all groups in one pass, as ``mark``."""
    return table.groupBy(*groups).agg(F.max(field).alias("mark"))


def with_epoch(known: DataFrame, marks: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """A mark for every known group: the epoch where nothing is loaded yet."""
    joined = known.select(*groups).distinct().join(marks, list(groups), "left")
    return joined.withColumn("mark", F.coalesce("mark", F.lit(EPOCH).cast("timestamp_ntz")))


def fresh_records(
    records: DataFrame, marks: DataFrame, groups: tuple[str, ...], updated: Column, also: Column | None = None
) -> DataFrame:
    """Records updated on or after the day of their group's mark, and those ``also`` holds for.

    The day counts as a whole; the merge's own condition settles repeats. Records of
    unknown groups pass, and so do those without a readable time, so that they reach
    the rejects. Marks hold one row per group: Spark broadcasts them when small, and
    AQE splits a hot group's records otherwise.
    """
    joined = records.withColumn("_day", to_day(updated)).join(marks, list(groups), "left")
    since = F.to_date(F.coalesce("mark", F.lit(EPOCH).cast("timestamp_ntz")))
    passes = F.col("_day").isNull() | (F.col("_day") >= since)
    return joined.filter(passes if also is None else passes | also).drop("_day", "mark")


def load(
    records: DataFrame,
    mode: Mode = "new",
    *,
    marks: DataFrame | None = None,
    groups: tuple[str, ...] = (),
    updated: Column | None = None,
    also: Column | None = None,
    key: str | None = None,
    sample_size: int = 3,
) -> DataFrame:
    """Records to take in: those new since the marks (and those ``also`` holds for), all of them,
    or a small sample of each group."""
    if mode == "all":
        return records
    if mode == "sample":
        if key is None:
            raise ValueError("a sample needs the record's key")
        return sample_rows(records, key, sample_size, groups=groups)
    if marks is None or updated is None:
        raise ValueError("new records need marks and the time they were updated")
    return fresh_records(records, marks, groups, updated, also)


def reject_reason(required: dict[str, Column], times: dict[str, Column]) -> Column:
    """Why a record cannot be taken in, or NULL if it can.

    ``required`` values must be there; ``times`` may be missing but not malformed.
    """
    checks = [F.when(c.isNull(), F.lit(f"missing {name}")) for name, c in required.items()]
    checks += [F.when(is_malformed_time(c), F.lit(f"malformed {name}")) for name, c in times.items()]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def split_rejects(records: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good records, rejects with their ``reject_reason``)."""
    marked = records.withColumn("reject_reason", reason)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())
