"""MERGE as DataFrame joins: update, insert and soft delete by key.

``merge_plan`` is the lazy form: two DataFrames in, the merged rows and the action
taken on each out. ``sources.catalog.merge_into`` applies it to a catalog table.

Shape of the plans, chosen for a large target and a source of any size:

* ``merge_decisions``, which table merges use, is a tagged union: keys and condition columns of
  both sides go through one shuffle, and one aggregate per key gives the action and tells
  whether a key is repeated on either side. Keys are unique, so there is nothing to combine
  before the shuffle and no hot key behind it.
* The lazy plan is a full outer join, which moves each side once.
* With a source small enough to broadcast, target LEFT JOIN source gives updates, keeps and
  soft deletes, and an anti join against the keys that matched the inserts, so that the target
  is never shuffled at all.
* Rows with a NULL key never match, so they go around the shuffles instead of meeting
  in one hash partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import any_null

ACTION, TARGETS, SOURCES = "_action", "_targets", "_sources"
ACTIONS = INSERT, UPDATE, KEEP, SOFT_DELETE = "insert", "update", "keep", "soft_delete"
METRICS = (
    "num_affected_rows bigint, num_updated_rows bigint, num_deleted_rows bigint, num_inserted_rows bigint"
)

# One side of the merge: a (possibly nested) column path to a Column.
Side = Callable[[str], Column]


@dataclass(frozen=True)
class MergeSpec:
    """A merge policy.

    ``update_when(target, source)`` decides matched rows (None: always). Target rows
    without a source row get the values of ``by_source_set`` where
    ``by_source_when(target)`` holds.
    ``partition_by`` names key columns the target is partitioned by, so that a merge
    rewrites only the partitions it changes. Where no key column suits, ``buckets`` deals the
    table's rows to that many hidden partitions by a hash of their keys, with the same effect;
    0 makes as many as the first rows' size asks for.
    """

    keys: tuple[str, ...]
    update_when: Callable[[Side, Side], Column] | None = None
    by_source_when: Callable[[Side], Column] | None = None
    by_source_set: Mapping[str, object] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    buckets: int | None = None

    def __post_init__(self):
        if not self.keys:
            raise ValueError("a merge needs at least one key column")
        stray = set(self.partition_by) - set(self.keys)
        if stray:
            raise ValueError(f"partition columns must be keys; {sorted(stray)} are not")
        if bool(self.by_source_set) != (self.by_source_when is not None):
            raise ValueError("by_source_when and by_source_set go together")
        if self.buckets is not None and (self.partition_by or self.buckets < 0):
            raise ValueError("buckets are a number, for tables without partition columns")


class DuplicateKeys(ValueError):
    """Several source rows share one key, so the update would be ambiguous."""


def check_columns(target: DataFrame, source: DataFrame, spec: MergeSpec) -> None:
    """Updates and inserts resolve by name, so both sides need the same columns."""
    missing = set(target.columns) ^ set(source.columns)
    if missing:
        raise ValueError(f"target and source differ in columns {sorted(missing)}")
    absent = [c for c in (*spec.keys, *spec.by_source_set) if c not in target.columns]
    if absent:
        raise ValueError(f"the merge names columns {absent} the tables do not have")


def check_unique(source: DataFrame, keys: tuple[str, ...]) -> None:
    """Refuse a source in which two rows share a (non-NULL) key."""
    repeated = (
        source.filter(~any_null(keys)).groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
    )
    sample = repeated.limit(3).collect()
    if sample:
        raise DuplicateKeys(f"source keys are not unique, for example {[tuple(r) for r in sample]}")


def merge_plan(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    broadcast_source: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Merged rows with the action taken on each in ``_action``.

    Source keys must be unique (``check_unique``). ``broadcast_source`` is for a source
    proven small. ``columns`` limits the output, which prunes both scans.
    """
    check_columns(target, source, spec)
    keys = spec.keys
    order = target.columns
    out = order if columns is None else columns
    source = source.select(*order)

    t = target.filter(~any_null(keys))
    s = source.filter(~any_null(keys))
    fresh = _with_action(source.filter(any_null(keys)), INSERT, out)
    if broadcast_source:
        rows = _matched(target, s, spec, out).unionByName(_with_action(_unmatched_source(t, s, keys), INSERT, out))
        return rows.unionByName(fresh)
    return _outer(t, s, spec, out).unionByName(fresh).unionByName(_by_source(target.filter(any_null(keys)), spec, out))


def merge_actions(
    target: DataFrame, source: DataFrame, spec: MergeSpec, broadcast_source: bool = False
) -> DataFrame:
    """Keys and action of every row: reads no more than key and condition columns."""
    return merge_plan(target, source, spec, broadcast_source, columns=list(spec.keys))


def merge_decisions(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Keys, action, and how many rows of either side have the key (``_targets``, ``_sources``).

    One row per whole key, and one for every row without one. Where a target key is repeated, its
    one action stands for rows that may differ; ``merge_actions`` decides such rows one by one.
    """
    check_columns(target, source, spec)
    keys, paths = spec.keys, condition_paths(spec)
    name = {(side, path): f"_{side}_{k}" for k, (side, path) in enumerate(paths)}

    def tagged(df: DataFrame, side: str) -> DataFrame:
        seen = [F.col(p).alias(name[s, p]) for s, p in paths if s == side]
        tags = [F.lit(int(side == x)).alias(tag) for x, tag in (("t", TARGETS), ("s", SOURCES))]
        return df.filter(~any_null(keys)).select(*keys, *tags, *seen)

    union = tagged(target, "t").unionByName(tagged(source, "s"), allowMissingColumns=True)
    # Each side has one row per key, so any value that is not NULL is that row's.
    values = [F.any_value(c, F.lit(True)).alias(c) for c in name.values()]
    counts = [F.sum(c).cast("bigint").alias(c) for c in (TARGETS, SOURCES)]
    # The shuffle first: both halves of the aggregate then run behind it, sorting once at most.
    met = union.repartition(*keys).groupBy(*keys).agg(*counts, *values)
    both, gone = (F.col(TARGETS) > 0) & (F.col(SOURCES) > 0), F.col(SOURCES) == 0
    seen = {side: (lambda path, side=side: F.col(name[side, path])) for side in "ts"}
    action = F.when(F.col(TARGETS) == 0, INSERT)
    action = action.when(both & (_holds(spec.update_when(seen["t"], seen["s"])) if spec.update_when else F.lit(True)), UPDATE)
    if spec.by_source_when:
        action = action.when(gone & _holds(spec.by_source_when(seen["t"])), SOFT_DELETE)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    decided = met.select(action.otherwise(KEEP).alias(ACTION), *keys, TARGETS, SOURCES)
    loose = _with_action(source.filter(any_null(keys)), INSERT, list(keys)).withColumns({TARGETS: none, SOURCES: one})
    out = decided.unionByName(loose)
    if spec.by_source_when:
        left = _by_source(target.filter(any_null(keys)), spec, list(keys)).withColumns({TARGETS: one, SOURCES: none})
        out = out.unionByName(left)
    return out


def condition_paths(spec: MergeSpec) -> list[tuple[str, str]]:
    """(side, column path) of everything that the policy's conditions look at."""
    seen: dict[tuple[str, str], None] = {}

    def side(which: str) -> Side:
        return lambda path: seen.setdefault((which, path)) or F.col(path)

    if spec.update_when:
        spec.update_when(side("t"), side("s"))
    if spec.by_source_when:
        spec.by_source_when(side("t"))
    return list(seen)


def merge_decided(
    target: DataFrame, source: DataFrame, spec: MergeSpec, changed: DataFrame, broadcast_changes: bool = False
) -> DataFrame:
    """The merged rows, given the changed keys that were decided.

    Only what changes something meets the target: source rows of updates, and the bare keys of
    soft deletes. They are often few where the source is large, and may then be broadcast.
    Inserts are known and need no second look at the target.
    """
    keys = spec.keys
    moves = decided_moves(source, spec, changed)
    moves = F.broadcast(moves) if broadcast_changes else moves
    joined = target.alias("t").join(moves.alias("s"), _key_match(keys), "left")
    t, s = _side("t"), _side("s")
    update = _holds(spec.update_when(t, s)) if spec.update_when else F.lit(True)
    action = F.when((s(ACTION) == UPDATE) & update, UPDATE)
    if spec.by_source_when:
        gone = (s(ACTION) == SOFT_DELETE) | reduce(lambda a, b: a | b, [t(k).isNull() for k in keys])
        action = action.when(gone & _holds(spec.by_source_when(t)), SOFT_DELETE)
    decided = joined.withColumn("_decided", action.otherwise(KEEP))
    rows = decided.select(*[t(c).alias(c) if c in keys else _value("_decided", c, spec).alias(c) for c in target.columns])
    return rows.unionByName(inserted_rows(source.select(*target.columns), keys, changed))


def decided_moves(source: DataFrame, spec: MergeSpec, changed: DataFrame) -> DataFrame:
    """Source rows that update something, and the keys of target rows to delete softly, by action."""
    moves = decided_rows(source, spec.keys, changed, UPDATE).withColumn(ACTION, F.lit(UPDATE))
    if not spec.by_source_when:
        return moves
    gone = changed.filter((F.col(ACTION) == SOFT_DELETE) & ~any_null(spec.keys)).select(*spec.keys).distinct()
    return moves.unionByName(gone.withColumn(ACTION, F.lit(SOFT_DELETE)), allowMissingColumns=True)


def decided_rows(source: DataFrame, keys: tuple[str, ...], changed: DataFrame, action: str) -> DataFrame:
    """Source rows whose (non-NULL) key was found to take the action."""
    hits = changed.filter(F.col(ACTION) == action).select(*keys).distinct()
    return source.join(hits, list(keys), "left_semi")


def inserted_rows(source: DataFrame, keys: tuple[str, ...], changed: DataFrame) -> DataFrame:
    """Source rows found to be new; a NULL key is always new."""
    new = decided_rows(source, keys, changed, INSERT)
    return new.unionByName(source.filter(any_null(keys)))


def merge_metrics(actions: DataFrame) -> DataFrame:
    """One row of counts over ``_action``; a soft delete counts as an update.

    No policy deletes rows, so ``num_deleted_rows`` is always 0.
    """

    def rows(*names: str) -> Column:
        return F.count_if(F.col(ACTION).isin(*names))

    return actions.agg(
        rows(INSERT, UPDATE, SOFT_DELETE).alias("num_affected_rows"),
        rows(UPDATE, SOFT_DELETE).alias("num_updated_rows"),
        F.lit(0).cast("bigint").alias("num_deleted_rows"),
        rows(INSERT).alias("num_inserted_rows"),
    )


def _side(alias: str) -> Side:
    return lambda path: F.col(f"{alias}.{path}")


def _holds(condition: Column) -> Column:
    """A NULL condition does not fire."""
    return F.coalesce(condition, F.lit(False))


def _key_match(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def _matched(t: DataFrame, s: DataFrame, spec: MergeSpec, out: list[str]) -> DataFrame:
    joined = t.alias("t").join(F.broadcast(s).alias("s"), _key_match(spec.keys), "left")
    target, source = _side("t"), _side("s")
    found = source(spec.keys[0]).isNotNull()
    update = _holds(spec.update_when(target, source)) if spec.update_when else F.lit(True)
    action = F.when(found & update, UPDATE)
    if spec.by_source_when:
        action = action.when(~found & _holds(spec.by_source_when(target)), SOFT_DELETE)
    decided = joined.withColumn(ACTION, action.otherwise(KEEP))
    # A key has the same value on both sides of an update.
    return decided.select(ACTION, *[target(c).alias(c) if c in spec.keys else _value(ACTION, c, spec).alias(c) for c in out])


def _value(action: str, name: str, spec: MergeSpec) -> Column:
    """A column of the merged row, of sides ``t`` and ``s``, by the action decided."""
    value = F.when(F.col(action) == UPDATE, F.col(f"s.{name}"))
    if name in spec.by_source_set:
        value = value.when(F.col(action) == SOFT_DELETE, F.lit(spec.by_source_set[name]))
    return value.otherwise(F.col(f"t.{name}"))


def _outer(t: DataFrame, s: DataFrame, spec: MergeSpec, out: list[str]) -> DataFrame:
    """Merged rows of whole keys by one full outer join."""
    joined = t.alias("t").join(s.alias("s"), _key_match(spec.keys), "full_outer")
    target, source = _side("t"), _side("s")
    in_t, in_s = target(spec.keys[0]).isNotNull(), source(spec.keys[0]).isNotNull()
    update = _holds(spec.update_when(target, source)) if spec.update_when else F.lit(True)
    action = F.when(~in_t, INSERT).when(in_s & update, UPDATE)
    if spec.by_source_when:
        action = action.when(~in_s & _holds(spec.by_source_when(target)), SOFT_DELETE)
    decided = joined.withColumn(ACTION, action.otherwise(KEEP))

    def merged(name: str) -> Column:
        if name in spec.keys:
            return F.coalesce(target(name), source(name))
        return F.when(F.col(ACTION) == INSERT, source(name)).otherwise(_value(ACTION, name, spec))

    return decided.select(ACTION, *[merged(c).alias(c) for c in out])


def _unmatched_source(t: DataFrame, s: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of a broadcast source that the target lacks, against the keys that met it."""
    present = t.select(*keys).join(F.broadcast(s.select(*keys)), list(keys), "left_semi")
    return s.alias("s").join(present.alias("t"), _key_match(keys), "left_anti")


def _by_source(t: DataFrame, spec: MergeSpec, out: list[str]) -> DataFrame:
    t = t.alias("t")
    if not spec.by_source_when:
        return _with_action(t, KEEP, out)
    fires = _holds(spec.by_source_when(_side("t")))
    marked = t.withColumn(ACTION, F.when(fires, SOFT_DELETE).otherwise(KEEP))
    return marked.select(
        ACTION,
        *[
            F.when(F.col(ACTION) == SOFT_DELETE, F.lit(spec.by_source_set[c])).otherwise(F.col(c)).alias(c)
            if c in spec.by_source_set
            else F.col(c)
            for c in out
        ],
    )


def _with_action(df: DataFrame, action: str, out: list[str]) -> DataFrame:
    return df.select(F.lit(action).alias(ACTION), *[F.col(c) for c in out])
