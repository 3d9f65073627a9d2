"""High-water marks as a table that every merge moves on, so that no run scans what is stored.

The table holds one row per group. A merge whose policy takes newer versions only (its field never
goes back) leaves each stored row at least as new as the one merged, so that the greater of the
old mark and the batch's own maximum is the group's new maximum. Marks move after the merge they
follow: if a run fails in between they lag, more records pass, and the merge's condition
settles the repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import high_water_marks
from tidemark.operators.merge import MergeSpec
from tidemark.operators.sizing import any_null
from tidemark.sources import catalog


def marks_spec(groups: tuple[str, ...]) -> MergeSpec:
    return MergeSpec(keys=groups, update_when=lambda t, s: s("mark") > t("mark"))


def marks_of(rows: DataFrame, groups: tuple[str, ...], field: str) -> DataFrame:
    """Marks of whole groups; a group without any time has none, which lets all its records pass."""
    return high_water_marks(rows, groups, field).filter(~any_null(groups) & F.col("mark").isNotNull())


def read_marks(spark: SparkSession, name: str, of: str, groups: tuple[str, ...], field: str) -> DataFrame | None:
    """The marks of the table ``of``; None if there is no such table.

    They are computed from the table only where nobody has kept them yet, and kept from then on.
    Marks of a table that is gone are dropped with it.
    """
    stored = catalog.read(spark, of)
    if stored is None:
        catalog.drop(spark, name)
        return None
    kept = catalog.read(spark, name)
    return catalog.create_as(marks_of(stored, groups, field), name) if kept is None else kept


def advance_marks(merged: DataFrame, name: str, groups: tuple[str, ...], field: str) -> DataFrame:
    """Move the marks on to what was just merged; the counts of their own merge.

    One aggregate over the batch, combined before its shuffle; the table is rewritten only if
    some group's mark moves.
    """
    return catalog.merge_into(marks_of(merged, groups, field), name, marks_spec(groups))
