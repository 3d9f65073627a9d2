"""Merges by one shuffle, hidden buckets, soft deletes in place, and tables kept from changes."""

import hashlib
from dataclasses import replace

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_merge import DDL, SPEC, by_hand, row, unique_source

from tidemark.operators.merge import ACTION, DuplicateKeys, MergeSpec, condition_paths, merge_decisions
from tidemark.operators.policies import EXPECTATIONS, PULLS, USERS
from tidemark.plans.derived import GroupedTable
from tidemark.sources import catalog

PLAIN = MergeSpec(SPEC.keys, SPEC.update_when)
unique_target = st.lists(row, max_size=10, unique_by=lambda r: r[:2] if None not in r[:2] else object())


def in_order(found):
    return sorted((tuple(r) for r in found), key=str)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=unique_target, source=unique_source, by_source=st.booleans())
def test_decisions_follow_the_rules(spark, target, source, by_source):
    spec = SPEC if by_source else PLAIN
    decided = merge_decisions(spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL), spec)
    got = in_order(decided.select(ACTION, "k", "j").collect())
    expected = in_order(r[:3] for r in by_hand(target, source, by_source))
    # Target rows without a key are only listed where they may be deleted softly.
    assert got == [r for r in expected if by_source or None not in r[1:] or r[0] != "keep"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(row, max_size=8), sources=st.lists(unique_source, min_size=1, max_size=2), by_source=st.booleans(), buckets=st.sampled_from([None, 3]), limit=st.sampled_from([0, 1 << 20]))
def test_table_merges_follow_the_rules(spark, target, sources, by_source, buckets, limit):
    """Merge after merge, in buckets or not, also with repeated target keys."""
    import uuid

    name = f"default.t{uuid.uuid4().hex}"
    spec = replace(SPEC if by_source else PLAIN, buckets=buckets)
    frame, parts = catalog._in_buckets(spark.createDataFrame(target, DDL), spec)
    catalog.create_as(frame, name, parts)
    expected = target
    try:
        for source in sources:
            moves = by_hand(expected, source, by_source)
            counts = catalog.merge_into(spark.createDataFrame(source, DDL), name, spec, limit).first()
            kinds = [m[0] for m in moves]
            assert counts["num_inserted_rows"] == kinds.count("insert")
            assert counts["num_updated_rows"] == kinds.count("update") + kinds.count("soft_delete")
            expected = [m[1:] for m in moves]
            assert in_order(catalog.read(spark, name).select("k", "j", "v", "gone").collect()) == in_order(expected)
    finally:
        catalog.drop(spark, name)


def test_conditions_tell_their_columns(spark):
    assert condition_paths(PULLS) == [("s", "time.updated"), ("t", "time.updated")]
    assert condition_paths(EXPECTATIONS) == [(side, c) for c in ("data_sources", "data_quality_issues") for side in "ts"] + [("t", "deprecated")]
    assert condition_paths(MergeSpec(("a",))) == []


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_repeated_source_keys_are_refused(spark, database, limit):
    name = f"{database}.t"
    catalog.merge_into(spark.createDataFrame([(1, 1, 1, None)], DDL), name, PLAIN)
    twice = spark.createDataFrame([(2, 1, 1, None), (2, 1, 2, None), (None, 1, 1, None), (None, 1, 1, None)], DDL)
    with pytest.raises(DuplicateKeys, match=r"\(2, 1, 2\)"):
        catalog.merge_into(twice, name, PLAIN, limit)
    assert rows(catalog.read(spark, name), "k") == [(1,)]
    assert tuple(catalog.merge_into(twice.filter("k is null"), name, PLAIN, limit).first()) == (2, 0, 0, 2)


def users(spark, *ids, title="u"):
    return spark.createDataFrame([(str(i), f"{title}{i}") for i in ids], "user_id string, user_name string")


def test_renames_replace_their_buckets_only(spark, database):
    name, spec = f"{database}.users", replace(USERS, buckets=16)
    catalog.merge_into(users(spark, *range(300)), name, spec)
    raw = catalog.read_raw(spark, name)
    hidden = catalog.bucket_column(raw.columns)
    assert hidden == "_bucket_of_16" and catalog.read(spark, name).columns == ["user_id", "user_name"]
    # Any engine can tell a row's bucket.
    bucket = lambda key: int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % 16
    assert all(r[hidden] == bucket(r["user_id"]) for r in raw.collect())
    before = set(raw.inputFiles())
    counts = catalog.merge_into(users(spark, 7, 8, title="new ").unionByName(users(spark, 9, 400)), name, spec).first()
    assert tuple(counts) == (3, 2, 0, 1)
    gone = before - set(catalog.read(spark, name).inputFiles())
    touched = {bucket(k) for k in ("7", "8", "400")}
    assert gone and {f.split(f"{hidden}=")[1].split("/")[0] for f in gone} <= {str(b) for b in touched}
    stored = catalog.read(spark, name)
    assert stored.count() == 301 and rows(stored.filter("user_name like 'new%'")) == [("7", "new 7"), ("8", "new 8")]
    # The same again writes nothing.
    before = set(stored.inputFiles())
    assert catalog.merge_into(users(spark, 7, 8, title="new "), name, spec).first()["num_affected_rows"] == 0
    assert set(catalog.read(spark, name).inputFiles()) == before


def test_a_table_gets_buckets_when_it_has_grown(spark, database, monkeypatch):
    name = f"{database}.users"
    catalog.merge_into(users(spark, *range(10)), name, USERS)
    assert catalog.bucket_column(spark.table(name).columns) is None
    monkeypatch.setattr(catalog, "BUCKET_BYTES", 4000)
    catalog.merge_into(users(spark, *range(5, 200), title="v"), name, USERS)
    hidden = catalog.bucket_column(catalog.read_raw(spark, name).columns)
    assert hidden and int(hidden.rsplit("_", 1)[1]) > 1
    assert catalog.read(spark, name).count() == 200
    before = set(catalog.read(spark, name).inputFiles())
    assert tuple(catalog.merge_into(users(spark, 1, title="w"), name, USERS).first()) == (1, 1, 0, 0)
    assert len(before - set(catalog.read(spark, name).inputFiles())) == 1
    # And another number of them on request, or none.
    assert catalog.rebucket(spark, name, replace(USERS, buckets=5)) == 5
    assert catalog.rebucket(spark, name, MergeSpec(("user_id",))) == 1
    assert spark.table(name).columns == ["user_id", "user_name"] and spark.table(name).count() == 200
    assert catalog.drop(spark, name) and not catalog.exists(spark, f"{name}__before")


def test_a_failed_replacement_leaves_the_table(spark, database):
    name = f"{database}.t"
    catalog.create_as(spark.range(3), name)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        catalog._replace_table(broken, name, ())
    assert catalog.read(spark, name).count() == 3
    # What an attempt that was cut off has left does no harm.
    spark.sql(f"CREATE TABLE {name}__before USING parquet LOCATION '{catalog._location(spark, name)}'")
    catalog.create(spark, name, "a int", replace=True)
    assert catalog.read(spark, name).columns == ["a"] and catalog.read(spark, name).count() == 0


def test_soft_deletes_touch_their_buckets(spark, database):
    name, spec = f"{database}.e", replace(EXPECTATIONS, buckets=32)
    ddl = "expectation_name string, data_sources array<string>, data_quality_issues array<string>, deprecated boolean"
    make = lambda names, v="a": spark.createDataFrame([(n, [v], None, False) for n in names], ddl)
    names = [f"e{i}" for i in range(200)]
    catalog.merge_into(make(names), name, spec)
    before = set(catalog.read(spark, name).inputFiles())
    kept = [n for n in names if n not in ("e3", "e4")]
    for limit in (0, 1 << 20):
        assert tuple(catalog.merge_into(make(kept), name, spec, limit).first()) == ((2, 2, 0, 0) if limit == 0 else (0, 0, 0, 0))
    stored = catalog.read(spark, name)
    assert rows(stored.filter("deprecated"), "expectation_name") == [("e3",), ("e4",)]
    assert 1 <= len(before - set(stored.inputFiles())) <= 2
    # One returns as it was and stays deprecated, one with a change and is not.
    back = make([*kept, "e3"]).unionByName(make(["e4"], "b"))
    assert tuple(catalog.merge_into(back, name, spec).first()) == (1, 1, 0, 0)
    assert rows(catalog.read(spark, name).filter("deprecated"), "expectation_name") == [("e3",)]


def test_changes_of_a_merge(spark, database):
    name = f"{database}.t"
    for spec, table in ((PLAIN, name), (replace(PLAIN, buckets=4), f"{name}2")):
        with catalog.merging(spark.createDataFrame([(i, 1, 1, None) for i in range(6)], DDL), table, spec) as merged:
            assert rows(merged.changes.groupBy(ACTION).count()) == [("insert", 6)]
        with catalog.merging(spark.createDataFrame([(1, 1, 2, None), (2, 1, 0, None), (9, 1, 1, None)], DDL), table, spec) as merged:
            assert merged.changes.columns == [ACTION, "k", "j"]
            assert rows(merged.changes) == [("insert", 9, 1), ("update", 1, 1)]
            assert tuple(merged.counts.first()) == (2, 1, 0, 1)


@pytest.mark.parametrize("parts", [(), ("repo_id",)])
def test_grouped_table_reads_touched_groups_only(spark, database, parts):
    spec = replace(PULLS, partition_by=parts)
    make = lambda *v: spark.createDataFrame([(r, p, (u,)) for r, p, u in v], "repo_id string, pull_id string, time struct<updated: int>")
    fold = lambda df: df.groupBy("repo_id").agg(F.count("*").alias("n"), F.max("time.updated").alias("newest"))
    derived = GroupedTable(f"{database}.g", f"{database}.p", ("repo_id",), fold)
    catalog.merge_into(make(*[(f"r{i % 5}", str(i), 1) for i in range(40)], (None, "x", 9)), derived.base, spec)
    assert tuple(derived.refresh(spark).first()) == (5, 0, 0, 5)
    batch = make(("r1", "1", 2), ("r2", "2", 1), ("r7", "70", 4), (None, "y", 1))
    with catalog.merging(batch, derived.base, spec) as merged:
        touched = derived.touched(merged.changes.filter("repo_id is not null"))
        assert rows(touched.groupBy("repo_id").count()) == [("r1", 8), ("r7", 1)]
        if parts:
            plan = touched._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [repo_id" in plan.replace("isnotnull(repo_id", "repo_id") or "repo_id#" in plan.split("PartitionFilters: [")[1].split("]")[0]
            assert {f.split("repo_id=")[1].split("/")[0] for f in touched.inputFiles()} >= {"r1", "r7"}
        assert tuple(derived.refresh(spark, merged.changes).first()) == (2, 1, 0, 1)
    whole = fold(catalog.read(spark, derived.base).filter("repo_id is not null"))
    assert rows(catalog.read(spark, derived.name)) == rows(whole)
    # Nothing changed: nothing is folded.
    with catalog.merging(batch.filter("repo_id is not null"), derived.base, spec) as merged:
        assert tuple(derived.refresh(spark, merged.changes).first()) == (0, 0, 0, 0)
