"""Catalog tables: create, read, append, publish, merge into and drop.

Tables are Parquet. An unpartitioned table is replaced by writing a new version folder
and pointing the catalog at it: readers see the old version or the new one, and a
failed write leaves the table as it was. A partitioned table is changed by dynamic
partition overwrite, which replaces only the partitions written. One writer per table
is assumed.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from threading import Lock

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.merge import (
    ACTION,
    ACTIONS,
    INSERT,
    KEEP,
    METRICS,
    SOFT_DELETE,
    SOURCES,
    TARGETS,
    UPDATE,
    DuplicateKeys,
    MergeSpec,
    check_columns,
    check_unique,
    decided_moves,
    inserted_rows,
    merge_actions,
    merge_decided,
    merge_decisions,
    merge_metrics,
)
from tidemark.operators.sizing import (
    BROADCAST_BYTES,
    LITERAL_PARTITIONS,
    fits_broadcast,
    listed_partitions,
    measured,
    only_partitions,
)
from tidemark.session import remove_path
from tidemark.sources.staging import staged

VERSION = "version-"
# A hidden partition column; its name tells the number of buckets.
BUCKET = "_bucket_of_"
BUCKET_BYTES = 256 << 20
_overwriting = Lock()


def split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """``database.table`` as its two parts; the database must exist."""
    parts = name.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"'{name}' is not of the form database.table")
    if not spark.catalog.databaseExists(parts[0]):
        raise ValueError(f"there is no database '{parts[0]}'")
    return parts[0], parts[1]


def exists(spark: SparkSession, name: str) -> bool:
    split_name(spark, name)
    return spark.catalog.tableExists(name)


def read(spark: SparkSession, name: str) -> DataFrame | None:
    """The table's current version, or None if there is none.

    A session remembers where a table was when it first read it; the refresh makes it
    see a version that another session has published since.
    """
    table = read_raw(spark, name)
    return None if table is None else table.drop(*[c for c in table.columns if _buckets_in(c)])


def read_raw(spark: SparkSession, name: str) -> DataFrame | None:
    """As ``read``, with the bucket column of a table that has one."""
    if not exists(spark, name):
        return None
    spark.catalog.refreshTable(name)
    return spark.table(name)


def bucket_of(keys: tuple[str, ...], buckets: int) -> Column:
    """The bucket of a row's key: from an MD5 of its columns as text, so that any engine can tell it."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys])
    return F.pmod(F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def bucket_column(columns: list[str]) -> str | None:
    return next((c for c in columns if _buckets_in(c)), None)


def _buckets_in(column: str) -> int | None:
    found = re.fullmatch(BUCKET + r"(\d+)", column)
    return int(found[1]) if found else None


def parse_ddl(ddl: str) -> StructType:
    """Column definitions as a schema; text that is not DDL raises."""
    schema = StructType.fromDDL(ddl)
    if not schema.fields:
        raise ValueError("a table needs at least one column")
    return schema


def create(
    spark: SparkSession,
    name: str,
    ddl: str,
    replace: bool = False,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """An empty table with the given columns. An existing one is an error unless ``replace``."""
    empty = spark.createDataFrame([], parse_ddl(ddl))
    if not exists(spark, name):
        return _first_version(empty, name, partition_by)
    if not replace:
        raise ValueError(f"table {name} exists; pass replace=True to replace it")
    _replace_table(empty, name, partition_by)
    return spark.table(name)


def ensure_like(like: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The table, created empty with ``like``'s columns if it is absent."""
    spark = like.sparkSession
    found = read(spark, name)
    return _first_version(like.limit(0), name, partition_by) if found is None else found


def create_as(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """A new table holding ``df``; an existing one is an error."""
    if exists(df.sparkSession, name):
        raise ValueError(f"table {name} exists; drop it first")
    return _first_version(df, name, partition_by)


def append(df: DataFrame, name: str, by_name: bool = True) -> None:
    """Add rows: columns are matched by name, or by position if asked."""
    _in_table_order(df, name, by_name).write.insertInto(name, overwrite=False)


def overwrite(df: DataFrame, name: str, by_name: bool = True) -> None:
    """Replace all rows. ``df`` may read the table itself."""
    rows = _in_table_order(df, name, by_name)
    if _partition_columns(df.sparkSession, name):
        with staged(rows, "overwrite") as frozen, _overwrite_mode(df.sparkSession, "static"):
            frozen.write.insertInto(name, overwrite=True)
    else:
        publish(rows.toDF(*df.sparkSession.table(name).columns), name)


def publish(df: DataFrame, name: str) -> None:
    """Make ``df`` the table's next version. ``df`` may read the current one."""
    spark = df.sparkSession
    if _partition_columns(spark, name):
        raise ValueError(f"{name} is partitioned; overwrite its partitions instead")
    path = _version_path(_table_root(spark, name))
    _in_table_order(df, name).write.parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace just the partitions that ``df`` has rows in. It may read the table itself,
    because new files are moved in only once all are written.

    The rebalance gathers each partition's rows into few files; AQE splits the hot
    ones among tasks and joins the small ones.
    """
    columns = _partition_columns(df.sparkSession, name)
    replace_partitions(df.hint("rebalance", *columns), name)


def replace_partitions(df: DataFrame, name: str) -> None:
    """As ``overwrite_partitions``, with the rows' distribution left as it is."""
    with _overwrite_mode(df.sparkSession, "dynamic"):
        _in_table_order(df, name).write.insertInto(name, overwrite=True)


@dataclass(frozen=True)
class Merged:
    """What a merge did: its counts, and the keys of changed rows with the action on each.

    The changes are staged files that live as long as the ``merging`` block.
    """

    counts: DataFrame
    changes: DataFrame


def merge_into(
    source: DataFrame,
    name: str,
    spec: MergeSpec,
    broadcast_limit: int = BROADCAST_BYTES,
    frozen: bool = False,
) -> DataFrame:
    """Merge ``source`` into the table, creating it from the source if absent.

    Returns the counts of ``merge_metrics``. The source is staged once, unless it is
    ``frozen``: read from files that do not change. A first, narrow pass over keys and
    condition columns finds the changes and stages their keys. The wide pass then writes
    no more than they need: nothing; an append, where all changes are inserts; the
    touched partitions or buckets; or the whole table as its next version.
    """
    with merging(source, name, spec, broadcast_limit, frozen) as merged:
        return merged.counts


@contextmanager
def merging(
    source: DataFrame, name: str, spec: MergeSpec, broadcast_limit: int = BROADCAST_BYTES, frozen: bool = False
) -> Iterator[Merged]:
    """``merge_into`` for a block that also needs to know which keys changed."""
    spark = source.sparkSession
    target = read_raw(spark, name)
    if target is None:
        counts = _bootstrap(source, name, spec)
        new = read(spark, name).select(F.lit(INSERT).alias(ACTION), *spec.keys)
        yield Merged(counts, new)
        return
    hidden = bucket_column(target.columns)
    check_columns(target.drop(hidden) if hidden else target, source, spec)
    if hidden:
        source = source.withColumn(hidden, bucket_of(spec.keys, _buckets_in(hidden)))
        spec = replace(spec, keys=(*spec.keys, hidden), partition_by=(hidden,), buckets=None)
    source = source.select(*target.columns)
    with _kept(source, frozen) as source, _merge(target, source, name, spec, broadcast_limit) as (counts, changed):
        yield Merged(spark.createDataFrame([counts], METRICS), changed.drop(hidden) if hidden else changed)


@contextmanager
def _kept(source: DataFrame, frozen: bool) -> Iterator[DataFrame]:
    if frozen:
        yield source
    else:
        with staged(source, "merge-source") as source:
            yield source


@contextmanager
def _merge(target: DataFrame, source: DataFrame, name: str, spec: MergeSpec, limit: int) -> Iterator[tuple[tuple[int, ...], DataFrame]]:
    parts = tuple(_partition_columns(source.sparkSession, name))
    if not set(parts) <= set(spec.keys):
        raise ValueError(f"{name} is partitioned by {parts}, which are not all merge keys")
    small = fits_broadcast(source, limit)
    if parts and not spec.by_source_when:
        listed = listed_partitions(source, parts)
        target = only_partitions(target, source if listed is None else listed, parts)
    with _changes(target, source, spec, small) as changed:
        counts, touched = _tally(changed, parts)
        affected, updated, _, _ = counts
        if affected and not updated:
            inserts = inserted_rows(source, spec.keys, changed)
            append(inserts.hint("rebalance", *parts) if parts else inserts, name)
        elif affected:
            if parts:
                target, source = (only_partitions(df, touched, parts) for df in (target, source))
            few = fits_broadcast(decided_moves(source, spec, changed), limit, rows=updated)
            merged = merge_decided(target, source, spec, changed, few)
            if parts:
                overwrite_partitions(merged, name)
            elif spec.buckets is not None:
                _publish_in_buckets(merged, name, spec)
            else:
                publish(merged, name)
        yield counts, changed


@contextmanager
def _changes(target: DataFrame, source: DataFrame, spec: MergeSpec, small: bool) -> Iterator[DataFrame]:
    """Keys and action of all rows that change, staged; repeated source keys are refused.

    One shuffle of narrow rows decides and checks at once. Rows of a repeated target key may
    differ, so where there is one, which a table that only merges wrote never has, rows
    are decided again one by one.
    """
    if small:
        check_unique(source, spec.keys)
    else:
        decided = merge_decisions(target, source, spec)
        doubtful = (F.col(SOURCES) > 1) | ((F.col(TARGETS) > 1) & (F.col(SOURCES) > 0))
        with staged(decided.filter((F.col(ACTION) != KEEP) | doubtful), "merge-changes") as changed:
            most = changed.agg(F.max(SOURCES).alias("s"), F.max(TARGETS).alias("t")).first()
            if (most["s"] or 0) > 1:
                check_unique(source, spec.keys)
            if (most["t"] or 0) <= 1:
                yield changed.drop(SOURCES, TARGETS)
                return
    with staged(merge_actions(target, source, spec, small).filter(F.col(ACTION) != KEEP), "merge-changes") as changed:
        yield changed


def _tally(changed: DataFrame, parts: tuple[str, ...]) -> tuple[tuple[int, ...], DataFrame | list[Row]]:
    """(counts in the order of METRICS, changed partitions) of the staged changes.

    The partitions are fetched if they are few, and left as a DataFrame if not.
    """
    per_part = changed.groupBy(ACTION, *parts).agg(F.count("*").alias("_rows"))
    rows = per_part.limit(LITERAL_PARTITIONS + 1).collect()
    if len(rows) > LITERAL_PARTITIONS:
        return tuple(merge_metrics(changed).first()), changed
    count = {action: sum(r["_rows"] for r in rows if r[ACTION] == action) for action in ACTIONS}
    updated = count[UPDATE] + count[SOFT_DELETE]
    touched = {tuple(r[c] for c in parts): r for r in rows}
    return (updated + count[INSERT], updated, 0, count[INSERT]), list(touched.values())


def _bootstrap(source: DataFrame, name: str, spec: MergeSpec) -> DataFrame:
    """First run: everything is inserted, so the source becomes the table as it is."""
    spark = source.sparkSession
    rows, parts = _in_buckets(source, spec)
    create_as(rows, name, parts)
    table = read(spark, name)
    try:
        check_unique(table, spec.keys)
    except DuplicateKeys:
        drop(spark, name)
        raise
    rows = table.count()
    return spark.createDataFrame([(rows, 0, 0, rows)], METRICS)


def _in_buckets(rows: DataFrame, spec: MergeSpec) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows with their bucket column, and the columns to partition a new table by."""
    if spec.buckets is None:
        return rows, spec.partition_by
    buckets = spec.buckets or math.ceil(measured(rows) / BUCKET_BYTES)
    if buckets <= 1:
        return rows, ()
    hidden = f"{BUCKET}{buckets}"
    return rows.withColumn(hidden, bucket_of(spec.keys, buckets)), (hidden,)


def _publish_in_buckets(df: DataFrame, name: str, spec: MergeSpec) -> None:
    """The next version of a table that has no buckets yet; with them if it has grown that far."""
    with staged(df, "merge-rows") as rows:
        bucketed, parts = _in_buckets(rows, spec)
        if parts:
            _replace_table(bucketed, name, parts)
        else:
            publish(rows, name)


def rebucket(spark: SparkSession, name: str, spec: MergeSpec) -> int:
    """Write a table anew in as many buckets as ``spec`` asks for; their number, 1 for a plain table."""
    with staged(read(spark, name), "rebucket") as rows:
        bucketed, parts = _in_buckets(rows, spec)
        _replace_table(bucketed, name, parts)
    return _buckets_in(parts[0]) if parts else 1


def _replace_table(df: DataFrame, name: str, partition_by: tuple[str, ...]) -> None:
    """Another table in place of this one, with other partition columns.

    The catalog cannot change a table's partitioning, so the new one is written beside it and
    takes over its name; until then, and if writing fails, the old one stays.
    """
    spark, beside, before = df.sparkSession, f"{name}__next", f"{name}__before"
    # What a failed attempt left has its files below the same folder, so only the entries go.
    for left in (beside, before):
        spark.sql(f"DROP TABLE IF EXISTS {left}")
    _first_version(df, beside, partition_by, home=_table_root(spark, name))
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    location = _location(spark, before)
    spark.sql(f"DROP TABLE {before}")
    remove_path(spark, location)
    spark.catalog.refreshTable(name)


def drop(spark: SparkSession, name: str, purge: bool = True) -> bool:
    """Drop the table, with its files if ``purge``. False if there was none."""
    if not exists(spark, name):
        return False
    location, root = _location(spark, name), _table_root(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if purge:
        for folder in {location, root}:
            remove_path(spark, folder)
    return True


def drop_all(spark: SparkSession, names: list[str], purge: bool = True) -> DataFrame:
    """Drop several tables and report which of them existed."""
    report = [(name, drop(spark, name, purge)) for name in names]
    return spark.createDataFrame(report, "table_name string, dropped boolean")


def ddl_text(spark: SparkSession, name: str) -> str | None:
    """The table's CREATE statement on one line; None if absent."""
    if not exists(spark, name):
        return None
    return spark.sql(f"SHOW CREATE TABLE {name}").first()[0].replace("\n", " ")


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """``insertInto`` heeds only the session's overwrite mode, not a writer option.

    The mode is the session's, so threads that share one take turns.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _overwriting:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _in_table_order(df: DataFrame, name: str, by_name: bool = True) -> DataFrame:
    if not by_name:
        return df
    columns = df.sparkSession.table(name).columns
    stray = set(df.columns) ^ set(columns)
    if stray:
        raise ValueError(f"columns {sorted(stray)} are not in both {name} and the rows")
    return df.select(*columns)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def location(spark: SparkSession, name: str) -> str:
    """The folder of the table's current version."""
    return _location(spark, name)


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    # The table's own columns are described first, and one may have that name.
    return described.collect()[-1]["data_type"]


def _table_root(spark: SparkSession, name: str) -> str:
    """The folder of the table's versions: above its current one, or beside a table
    that was not made here."""
    location = _location(spark, name)
    parent, leaf = location.rsplit("/", 1)
    return parent if leaf.startswith(VERSION) else f"{location}.versions"


def _version_path(root: str) -> str:
    return f"{root}/{VERSION}{uuid.uuid4().hex}"


def _first_version(df: DataFrame, name: str, partition_by: tuple[str, ...], home: str | None = None) -> DataFrame:
    spark = df.sparkSession
    database, table = split_name(spark, name)
    home = home or f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"
    path = _version_path(home)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)
