"""Derived tables: a declared query plus a merge policy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import METRICS, MergeSpec, check_unique
from tidemark.operators.profile import require_rows
from tidemark.operators.sizing import any_null, listed_partitions, only_partitions
from tidemark.sources import catalog
from tidemark.sources.staging import staged


@dataclass(frozen=True)
class DerivedTable:
    """A table kept equal to ``build`` by merging its rows under ``spec``."""

    name: str
    build: Callable[[SparkSession], DataFrame]
    spec: MergeSpec

    def __post_init__(self):
        if not callable(self.build):
            raise TypeError("build must be a function from a session to a DataFrame")
        if not isinstance(self.spec, MergeSpec):
            raise TypeError("spec must be a MergeSpec")

    @classmethod
    def from_select(cls, name: str, select: str, spec: MergeSpec) -> DerivedTable:
        """A derived table whose query is SQL text; it must be a SELECT."""
        if not isinstance(select, str) or not select.strip().lower().startswith("select"):
            raise ValueError("the query must be text that starts with 'select'")
        return cls(name, lambda spark: spark.sql(select), spec)

    def refresh(self, spark: SparkSession) -> DataFrame:
        """Run the query once, then merge its rows or create the table from them if absent.

        A query without rows is an error. Returns the merge's counts; right after its
        creation a table needs no change, so they are zero.
        """
        with staged(self.build(spark), "derived") as rows:
            require_rows(rows)
            if catalog.exists(spark, self.name):
                return catalog.merge_into(rows, self.name, self.spec, frozen=True)
            check_unique(rows, self.spec.keys)
            catalog.create_as(rows, self.name, self.spec.partition_by)
        return spark.createDataFrame([(0, 0, 0, 0)], METRICS)


@dataclass(frozen=True)
class GroupedTable:
    """One row per group of a base table's rows, kept up to date from what merges change.

    ``fold`` makes the groups' rows from base rows, one for each value of ``groups``, which are
    merge keys of the base and the keys of this table. So the keys that a merge has staged tell
    which groups to fold again; all others stay as they are and are not read.
    """

    name: str
    base: str
    groups: tuple[str, ...]
    fold: Callable[[DataFrame], DataFrame]

    def spec(self, spark: SparkSession) -> MergeSpec:
        """A group's row is replaced if any of its values differs."""
        values = [c for c in self.fold(catalog.read(spark, self.base)).columns if c not in self.groups]

        def differs(t, s):
            return reduce(lambda a, b: a | b, [~t(c).eqNullSafe(s(c)) for c in values])

        return MergeSpec(keys=self.groups, update_when=differs if values else None)

    def touched(self, changes: DataFrame) -> DataFrame:
        """The base rows of all groups with a changed key.

        Where the base is partitioned by the groups and they are few, its other folders are not
        opened; otherwise a semi join on the groups keeps the list off the driver.
        """
        spark = changes.sparkSession
        base = catalog.read(spark, self.base)
        listed = listed_partitions(changes, self.groups)
        return only_partitions(base, changes if listed is None else listed, self.groups)

    def refresh(self, spark: SparkSession, changes: DataFrame | None = None) -> DataFrame:
        """Fold the groups that ``changes`` (rows with the base's keys) name, or all without it or
        on the first run; the merge's counts.

        Groups with a NULL in their key have no row to be replaced, so they take no part.
        """
        if changes is None or not catalog.exists(spark, self.name):
            rows = self.fold(catalog.read(spark, self.base).filter(~any_null(self.groups)))
        else:
            rows = self.fold(self.touched(changes.filter(~any_null(self.groups))))
        return catalog.merge_into(rows, self.name, self.spec(spark))
