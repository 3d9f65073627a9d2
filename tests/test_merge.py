"""Merge semantics, against a plain-Python account of the same rules."""

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import policies, sizing
from tidemark.operators.merge import (
    ACTION,
    DuplicateKeys,
    MergeSpec,
    check_unique,
    merge_actions,
    merge_metrics,
    merge_plan,
)
from tidemark.plans import pulls
from tidemark.sources import catalog

DDL = "k int, j int, v int, gone boolean"
SPEC = MergeSpec(
    keys=("k", "j"),
    update_when=lambda t, s: s("v") > t("v"),
    by_source_when=lambda t: ~t("gone"),
    by_source_set={"gone": True},
)


def by_hand(target, source, by_source=True):
    """The merged rows with their actions, worked out row by row."""
    match = {r[:2]: r for r in source if None not in r[:2]}
    out, met = [], set()
    for row in target:
        key = row[:2]
        found = match.get(key) if None not in key else None
        if found is not None:
            met.add(key)
            newer = found[2] is not None and row[2] is not None and found[2] > row[2]
            out.append(("update", *found) if newer else ("keep", *row))
        elif by_source and row[3] is False:
            out.append(("soft_delete", *row[:3], True))
        else:
            out.append(("keep", *row))
    out += [("insert", *r) for r in source if None in r[:2] or r[:2] not in met]
    return sorted(out, key=str)


small = st.one_of(st.none(), st.integers(0, 3))
row = st.tuples(small, small, small, st.one_of(st.none(), st.booleans()))
unique_source = st.lists(row, max_size=8, unique_by=lambda r: r[:2] if None not in r[:2] else object())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(row, max_size=10), source=unique_source, by_source=st.booleans(), broadcast=st.booleans())
def test_merge_follows_the_rules(spark, target, source, by_source, broadcast):
    """Also with repeated target keys: each such row is decided on its own."""
    spec = SPEC if by_source else MergeSpec(SPEC.keys, SPEC.update_when)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    merged = merge_plan(t, s, spec, broadcast).select(ACTION, "k", "j", "v", "gone")
    got = sorted((tuple(r) for r in merged.collect()), key=str)
    expected = by_hand(target, source, by_source)
    assert got == expected
    counts = merge_metrics(merge_actions(t, s, spec, broadcast)).first()
    tally = [r[0] for r in expected]
    assert counts["num_inserted_rows"] == tally.count("insert")
    assert counts["num_updated_rows"] == tally.count("update") + tally.count("soft_delete")
    assert counts["num_affected_rows"] == len(tally) - tally.count("keep")
    assert counts["num_deleted_rows"] == 0


def test_rerun_changes_nothing(spark):
    t = spark.createDataFrame([(1, 1, 5, False), (2, 1, 5, False)], DDL)
    s = spark.createDataFrame([(1, 1, 6, False), (3, 1, 1, None)], DDL)
    once = merge_plan(t, s, SPEC).drop(ACTION)
    assert merge_metrics(merge_actions(once, s, SPEC)).first()["num_affected_rows"] == 0


def test_duplicate_source_keys_are_refused(spark, database):
    s = spark.createDataFrame([(1, 1, 1, None), (1, 1, 2, None), (None, 1, 1, None), (None, 1, 1, None)], DDL)
    with pytest.raises(DuplicateKeys):
        check_unique(s, SPEC.keys)
    check_unique(s.filter("k is null"), SPEC.keys)
    with pytest.raises(DuplicateKeys):
        catalog.merge_into(s, f"{database}.t", SPEC)
    assert not catalog.exists(spark, f"{database}.t")


def test_columns_must_agree(spark):
    t = spark.createDataFrame([], DDL)
    with pytest.raises(ValueError, match="gone"):
        merge_plan(t, t.drop("gone"), SPEC)
    shuffled = spark.createDataFrame([(True, 7, 2, 1)], "gone boolean, v int, j int, k int")
    assert rows(merge_plan(t, shuffled, SPEC), "k", "j", "v", "gone") == [(1, 2, 7, True)]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        MergeSpec(keys=())
    with pytest.raises(ValueError):
        MergeSpec(keys=("a",), partition_by=("b",))
    with pytest.raises(ValueError):
        MergeSpec(keys=("a",), by_source_set={"x": 1})


def test_expectations_revive_only_when_changed(spark):
    ddl = "expectation_name string, data_sources array<string>, data_quality_issues array<string>, deprecated boolean"
    t = spark.createDataFrame(
        [("same", ["a"], ["x"], True), ("changed", ["a"], ["x"], True), ("absent", ["a"], None, False), ("null", None, None, True)], ddl
    )
    s = spark.createDataFrame(
        [("same", ["a"], ["x"], False), ("changed", ["a", "b"], ["x"], False), ("null", ["a"], None, False)], ddl
    )
    merged = rows(merge_plan(t, s, policies.EXPECTATIONS), "expectation_name", ACTION, "deprecated")
    assert merged == [
        ("absent", "soft_delete", True),
        ("changed", "update", False),
        ("null", "keep", True),
        ("same", "keep", True),
    ]


def test_contributors_advance_only(spark):
    ddl = "org_id string, repo_id string, user_id string, last_week date, n int"
    t = spark.createDataFrame([("o", "r", "a", None, 1)], ddl).unionByName(
        spark.sql("select 'o' org_id, 'r' repo_id, 'b' user_id, date'2024-01-08' last_week, 1 n")
    )
    s = spark.sql(
        "select 'o' org_id, 'r' repo_id, u user_id, date'2024-01-08' last_week, 2 n from values ('a'), ('b') as x(u)"
    )
    assert rows(merge_plan(t, s, policies.CONTRIBUTORS), "user_id", ACTION, "n") == [("a", "keep", 1), ("b", "keep", 1)]


def version_of(spark, name):
    return catalog._location(spark, name)


@pytest.mark.parametrize("limit", [0, sizing.BROADCAST_BYTES])
def test_table_merge_matches_the_plan(spark, database, limit):
    name = f"{database}.t"
    target = [(1, 1, 5, False), (2, 1, 5, False), (None, 2, 1, False)]
    source = [(1, 1, 6, None), (3, 1, 1, False), (None, 9, 9, None)]
    spec = MergeSpec(SPEC.keys, SPEC.update_when, SPEC.by_source_when, SPEC.by_source_set)
    first = catalog.merge_into(spark.createDataFrame(target, DDL), name, spec).first()
    assert tuple(first) == (3, 0, 0, 3)
    counts = catalog.merge_into(spark.createDataFrame(source, DDL), name, spec, limit).first()
    expected = by_hand(target, source)
    assert sorted((tuple(r) for r in spark.table(name).collect()), key=str) == sorted((r[1:] for r in expected), key=str)
    assert tuple(counts) == (5, 3, 0, 2)


def test_merge_without_changes_writes_nothing(spark, database):
    name = f"{database}.t"
    spec = MergeSpec(("k", "j"), SPEC.update_when)
    df = spark.createDataFrame([(1, 1, 5, False)], DDL)
    catalog.merge_into(df, name, spec)
    before = version_of(spark, name)
    assert catalog.merge_into(df, name, spec).first()["num_affected_rows"] == 0
    assert version_of(spark, name) == before


@pytest.mark.parametrize("limit", [0, sizing.BROADCAST_BYTES])
def test_partitioned_merge_rewrites_touched_partitions_only(spark, database, limit):
    name = f"{database}.t"
    spec = MergeSpec(("k", "j"), SPEC.update_when, partition_by=("j",))
    catalog.merge_into(spark.createDataFrame([(i, i % 4, 1, False) for i in range(40)], DDL), name, spec)
    # Partition 1 is touched but unchanged, 2 gets an update, 9 is new.
    source = [(1, 1, 1, None), (2, 2, 8, None), (50, 9, 1, None)]
    files = lambda: {f for f in spark.table(name).inputFiles()}
    before = files()
    counts = catalog.merge_into(spark.createDataFrame(source, DDL), name, spec, limit).first()
    assert tuple(counts) == (2, 1, 0, 1)
    gone = before - files()
    assert gone and all("j=2" in f for f in gone)
    table = spark.table(name)
    assert table.count() == 41
    assert rows(table.filter("v <> 1"), "k", "j", "v") == [(2, 2, 8)]


def test_null_partition_is_kept_whole(spark, database):
    name = f"{database}.t"
    spec = MergeSpec(("k", "j"), SPEC.update_when, partition_by=("j",))
    catalog.merge_into(spark.createDataFrame([(1, None, 1, False), (1, 1, 1, False)], DDL), name, spec)
    catalog.merge_into(spark.createDataFrame([(2, None, 2, False)], DDL), name, spec)
    assert rows(spark.table(name), "k", "j", "v") == [(1, None, 1), (1, 1, 1), (2, None, 2)]


@pytest.mark.parametrize("by_source", [False, True])
def test_more_partitions_than_the_literal_limit(spark, database, monkeypatch, by_source):
    monkeypatch.setattr(catalog, "LITERAL_PARTITIONS", 3)
    monkeypatch.setattr(catalog, "listed_partitions", lambda r, p: sizing.listed_partitions(r, p, 3))
    name = f"{database}.t"
    spec = (
        MergeSpec(("k", "j"), SPEC.update_when, SPEC.by_source_when, SPEC.by_source_set, partition_by=("j",))
        if by_source
        else MergeSpec(("k", "j"), SPEC.update_when, partition_by=("j",))
    )
    target = [(i, i % 12 if i % 13 else None, 1, False) for i in range(60)]
    source = [(i, i % 12, 2, None) for i in range(0, 70, 7)]
    catalog.merge_into(spark.createDataFrame(target, DDL), name, spec)
    counts = catalog.merge_into(spark.createDataFrame(source, DDL), name, spec).first()
    expected = by_hand(target, source, by_source)
    got = spark.table(name).select("k", "j", "v", "gone").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((r[1:] for r in expected), key=str)
    assert counts["num_inserted_rows"] == sum(r[0] == "insert" for r in expected)


@pytest.mark.parametrize("parts", [(), ("j",)])
def test_empty_source(spark, database, parts):
    name, empty = f"{database}.t", spark.createDataFrame([], DDL)
    spec = MergeSpec(("k", "j"), SPEC.update_when, partition_by=parts)
    assert tuple(catalog.merge_into(empty, name, spec).first()) == (0, 0, 0, 0)
    catalog.merge_into(spark.createDataFrame([(1, 1, 1, None)], DDL), name, spec)
    assert tuple(catalog.merge_into(empty, name, spec).first()) == (0, 0, 0, 0)
    assert catalog.read(spark, name).count() == 1


def test_blocks_keep_a_hot_repository_local(spark, database):
    name = f"{database}.t"
    rows_of = lambda ids, v: pulls.in_blocks(
        spark.createDataFrame([("hot", str(i), (v,)) for i in ids], "repo_id string, pull_id string, time struct<updated: int>"), 10
    )
    catalog.merge_into(rows_of(range(100), 1), name, policies.PULLS_IN_BLOCKS)
    before = set(spark.table(name).inputFiles())
    counts = catalog.merge_into(rows_of(range(95, 105), 2), name, policies.PULLS_IN_BLOCKS).first()
    assert tuple(counts) == (10, 5, 0, 5)
    gone = before - set(catalog.read(spark, name).inputFiles())
    assert gone and all("pull_block=9/" in f for f in gone)
    assert catalog.read(spark, name).count() == 105


def test_session_overwrite_mode_is_restored(spark, database):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spec = MergeSpec(("k", "j"), partition_by=("j",))
    for _ in range(2):
        catalog.merge_into(spark.createDataFrame([(1, 1, 1, False)], DDL), f"{database}.t", spec)
    assert spark.conf.get(key) == before


def test_half_of_the_rows_without_a_key_are_not_shuffled(spark):
    """Rows with a NULL key stay out of the join's exchanges."""
    t = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.lit(1).alias("v"))
    spec = MergeSpec(("k",), lambda a, b: b("v") > a("v"))
    merged = merge_plan(t, t.filter("k is null or k < 10"), spec)
    assert merged.count() == 1000 + 500
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull" in plan.lower()


def test_size_bound_holds_for_wide_text(spark):
    text = F.lit("x" * 1000)
    df = spark.range(100).select("id", text.alias("a"), F.struct(text.alias("b")).alias("s"), F.array(text).alias("c"))
    assert sizing.measured(df) > 100 * 3000
    assert sizing.measured(df.limit(0)) == 0
    assert sizing.fits_broadcast(df, 1 << 20) and not sizing.fits_broadcast(df, 100_000)
    assert not sizing.fits_broadcast(spark.range(10_000), 10_000)
