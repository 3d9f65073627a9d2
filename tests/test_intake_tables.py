"""Marks and rejects that live in tables of their own, and texts that cannot be read."""

import dataclasses
import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import AT, DAY, contributor_page, doc, landed_orgs, landing, pull

from tidemark.operators.incremental import high_water_marks
from tidemark.operators.policies import PULLS
from tidemark.plans import expectations, orgs, pulls, workflow
from tidemark.sources import catalog, marks, quarantine

ARGS = (["acme"], ["abe"])
OLD = "2023-01-01T00:00:00Z"


def run(spark, database, data, day=1):
    counts = workflow.run_all(spark, database, data, *ARGS, at=datetime(2024, 4, day))
    return {r["table_name"]: r for r in counts.collect()}


def details(spark, data, *texts):
    made = [("acme", "abe", str(n), t if isinstance(t, str) else json.dumps(t)) for n, t in texts]
    return dataclasses.replace(data, details=spark.createDataFrame(made, workflow.KINDS["details"]))


def held(spark, database):
    return rows(spark.table(f"{database}.pull_rejects"), "pull_number", "reject_reason", "held_since")


def test_a_repaired_pull_passes_its_mark(spark, database):
    data = landing(spark, [pull(1), pull(2, updated=OLD), pull(3, updated=OLD)], [])
    counts = run(spark, database, details(spark, data, (2, "not json"), (3, "not json")))
    assert counts["source_pulls"]["num_inserted_rows"] == 1 and counts["source_pulls"]["num_rejected_rows"] == 2
    assert held(spark, database) == [("2", "unreadable details", datetime(2024, 4, 1)), ("3", "unreadable details", datetime(2024, 4, 1))]
    # The mark lies years after pull 2.
    assert spark.table(f"{database}.pull_marks").first()["mark"] == datetime(2024, 1, 5)

    again = details(spark, data, (2, {"comments": 7}), (3, "still not"))
    counts = run(spark, database, again, 2)
    assert counts["source_pulls"]["num_inserted_rows"] == 1
    stored = spark.table(f"{database}.source_pulls")
    assert rows(stored, "pull_number", "metrics.comment_count") == [("1", None), ("2", 7)]
    assert held(spark, database) == [("3", "unreadable details", datetime(2024, 4, 1))]

    where = [catalog._location(spark, f"{database}.{t}") for t in ("pull_rejects", "pull_marks")]
    counts = run(spark, database, again, 3)
    assert counts["source_pulls"]["num_affected_rows"] == 0 and counts["source_pulls"]["num_rejected_rows"] == 1
    assert where == [catalog._location(spark, f"{database}.{t}") for t in ("pull_rejects", "pull_marks")]
    assert held(spark, database) == [("3", "unreadable details", datetime(2024, 4, 1))]


def test_details_alone_bring_a_pull_back(spark, database):
    """The pull is not listed again; its row comes from what was kept of it."""
    data = landing(spark, [pull(1), pull(2, updated=OLD, labels=[{"name": "bug"}], draft=True)], [])
    run(spark, database, details(spark, data, (2, "not json")))
    later = landing(spark, [pull(1)], [])
    counts = run(spark, database, details(spark, later, (1, {"comments": 1}), (2, {"comments": 7})), 2)
    assert counts["source_pulls"]["num_inserted_rows"] == 1
    stored = spark.table(f"{database}.source_pulls").filter("pull_number = '2'")
    assert rows(stored, "pull_id", "title", "labels", "is_draft", "time.updated", "metrics.comment_count", "api_request_time") == [
        ("102", "t2", ["bug"], True, datetime(2023, 1, 1), 7, datetime(2024, 4, 2))
    ]
    assert held(spark, database) == []


def test_a_changed_reason_is_kept_since_the_first_run(spark, database):
    data = landing(spark, [pull(1), pull(2, user=None, updated=OLD)], [])
    run(spark, database, data)
    named = landing(spark, [pull(1), pull(2, updated=OLD)], [])
    run(spark, database, details(spark, named, (2, "not json")), 2)
    assert held(spark, database) == [("2", "unreadable details", datetime(2024, 4, 1))]
    # A full load also releases.
    counts = workflow.run_all(spark, database, named, *ARGS, at=AT, mode="all").filter("table_name = 'source_pulls'").first()
    assert counts["num_inserted_rows"] == 1 and held(spark, database) == []


def test_identities(spark, database):
    """Without a number a record is known by its id, without either by its content."""
    name = f"{database}.rejects"
    ddl = "repo_id string, pull_number string, pull_id string, reject_reason string"
    bad = spark.createDataFrame([("5", "1", "x", "a"), ("5", None, "102", "b"), ("5", None, None, "c"), (None, "4", "104", "d"), ("5", "1", "x", "a")], ddl)
    made = quarantine.held_rows(bad, pulls.IDENTITIES, ["repo_id", "pull_number", "pull_id"], AT)
    assert quarantine.settle(spark, name, made, bad.limit(0), pulls.IDENTITIES) == {"new": 4, "changed": 0, "released": 0, "held": 4}
    good = spark.createDataFrame([("5", "1", "101"), ("5", "2", "102"), ("6", "1", "101"), ("5", None, None), (None, "4", "104")], "repo_id string, pull_number string, pull_id string")
    flagged = quarantine.is_held(good, catalog.read(spark, name), pulls.IDENTITIES, "held")
    assert rows(flagged, "repo_id", "pull_number", "held") == [(None, "4", False), ("5", None, False), ("5", "1", True), ("5", "2", True), ("6", "1", False)]
    report = quarantine.settle(spark, name, made.filter("pull_id is null"), good, pulls.IDENTITIES)
    assert report == {"new": 0, "changed": 0, "released": 2, "held": 2}
    # Rejected and stored in one run: it stays held.
    again = quarantine.held_rows(bad.filter("pull_id = 'x'"), pulls.IDENTITIES, ["repo_id", "pull_number"], AT)
    assert quarantine.settle(spark, name, again, good, pulls.IDENTITIES)["new"] == 1
    assert quarantine.settle(spark, name, again, good, pulls.IDENTITIES) == {"new": 0, "changed": 0, "released": 0, "held": 3}


def test_held_keys_need_no_broadcast(spark, database, monkeypatch):
    monkeypatch.setattr(quarantine, "fits_broadcast", lambda df: False)
    test_details_alone_bring_a_pull_back(spark, database)


def test_contributors_are_held(spark, database):
    week = [(1704067200, 1, 1, 1)]
    page = lambda v: spark.createDataFrame([("acme", "abe", contributor_page((1, "ann", week), (2, "bob", [(1704067200, v, 1, 1)])))], workflow.KINDS["contributors"])
    data = landing(spark, [pull(1)], [])
    run(spark, database, dataclasses.replace(data, contributors=page("many")))
    assert rows(spark.table(f"{database}.contributor_rejects"), "user_id", "reject_reason") == [("2", "unreadable week")]
    run(spark, database, dataclasses.replace(data, contributors=page(4)), 2)
    assert spark.table(f"{database}.contributor_rejects").count() == 0
    assert rows(spark.table(f"{database}.source_contributors"), "user_id") == [("1",), ("2",)]


def test_a_second_run_reads_no_stored_pull_for_the_marks(spark, database, monkeypatch):
    data = landing(spark, [pull(1), pull(2)], [])
    run(spark, database, data)
    read = []
    monkeypatch.setattr(marks, "high_water_marks", lambda df, *a: read.extend(df.inputFiles()) or high_water_marks(df, *a))
    newer = landing(spark, [pull(1), pull(2, updated="2024-01-09T00:00:00Z"), pull(3, updated="2024-01-07T00:00:00Z")], [])
    assert run(spark, database, newer, 2)["source_pulls"]["num_affected_rows"] == 2
    stored = spark.table(f"{database}.source_pulls")
    assert read and not [f for f in read if "/source_pulls/" in f]
    kept = marks.read_marks(spark, f"{database}.pull_marks", f"{database}.source_pulls", ("org_id", "repo_id"), "time.updated")
    assert rows(kept) == rows(high_water_marks(stored, ("org_id", "repo_id"), "time.updated"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "pull_marks" in plan and "source_pulls" not in plan


def test_marks_of_a_table_loaded_before(spark, database):
    """Marks nobody has kept yet are computed once; those of a dropped table go with it."""
    name, kept = f"{database}.t", f"{database}.m"
    ddl = "repo_id string, pull_id string, time struct<updated: timestamp_ntz>"
    at = lambda d: (datetime(2024, 1, d),) if d else (None,)
    make = lambda *v: spark.createDataFrame([(r, str(i), at(d)) for i, (r, d) in enumerate(v)], ddl)
    assert marks.read_marks(spark, kept, name, ("repo_id",), "time.updated") is None
    catalog.merge_into(make(("a", 3), ("a", 5), ("b", None), (None, 9)), name, PULLS)
    read = lambda: rows(marks.read_marks(spark, kept, name, ("repo_id",), "time.updated"))
    assert read() == [("a", datetime(2024, 1, 5))]
    # Older versions, groups without a time or key move nothing; others are new.
    assert tuple(marks.advance_marks(make(("a", 4), ("b", None), (None, 9)), kept, ("repo_id",), "time.updated").first()) == (0, 0, 0, 0)
    assert tuple(marks.advance_marks(make(("a", 6), ("b", 1)), kept, ("repo_id",), "time.updated").first()) == (2, 1, 0, 1)
    assert read() == [("a", datetime(2024, 1, 6)), ("b", datetime(2024, 1, 1))]
    catalog.drop(spark, name)
    assert marks.read_marks(spark, kept, name, ("repo_id",), "time.updated") is None and not catalog.exists(spark, kept)


@pytest.mark.parametrize("column", ["members", "repos"])
def test_unreadable_lists_of_an_organization_are_errors(spark, column):
    good = landed_orgs(spark, ("acme", 7, [(1, "ann")], [(5, "abe")]))
    for text in ("not json", '{"id": "x"}', "[1, 2"):
        with pytest.raises(Exception, match=f"unreadable {column}"):
            orgs.org_snapshot(good.withColumn(column, F.lit(text)), DAY).collect()
    for text in (None, "null", "[]"):
        assert orgs.org_snapshot(good.withColumn(column, F.lit(text).cast("string")), DAY).count() == 1


def test_unreadable_expectations_are_errors(spark):
    texts = lambda *v: spark.createDataFrame([(t,) for t in v], "value string")
    for bad in ("busy", "[1]"):
        with pytest.raises(Exception, match="unreadable legacy document"):
            expectations.legacy_expectations(texts(bad)).collect()
    assert expectations.legacy_expectations(texts("{}")).count() == 0
    with pytest.raises(Exception, match="unreadable data_sources"):
        expectations.core_expectations(texts(doc("Expect A", {"x": 1}, []))).collect()
    assert rows(expectations.core_expectations(texts(doc("Expect A", None, ["B", "a"])))) == [("expect_a", None, ["a", "b"], False)]


def state(spark, database):
    return {t.name: catalog._location(spark, f"{database}.{t.name}") for t in spark.catalog.listTables(database)}


def test_all_tables_or_none(spark, database):
    run(spark, database, landing(spark, [pull(1)], [(1, "ann")], docs=[doc("Expect A", ["x"], [])]))
    before = state(spark, database)
    contents = {t: rows(catalog.read(spark, f"{database}.{t}")) for t in before}
    good = landing(spark, [pull(1, updated="2024-02-01T00:00:00Z"), pull(2)], [(2, "bob")], docs=[doc("Expect A", ["y"], [])])
    make = lambda kind, *v: spark.createDataFrame(list(v), workflow.KINDS[kind])
    spoilt = {
        "expectations": ("no title", make("expectations", ("busy",))),
        "repos": ("unreadable forks_count", make("repos", ("acme", "abe", '{"id": 5, "forks_count": "many"}'))),
        "pulls": ("unreadable page", make("pulls", ("acme", "abe", "busy"))),
        "contributors": ("not unique", make("contributors", *[("acme", "abe", contributor_page((1, "ann", [])))] * 2)),
    }
    for kind, (message, texts) in spoilt.items():
        with pytest.raises(Exception, match=message):
            run(spark, database, dataclasses.replace(good, **{kind: texts}), 2)
        assert state(spark, database) == before
    assert {t: rows(catalog.read(spark, f"{database}.{t}")) for t in before} == contents
    assert run(spark, database, good, 2)["source_pulls"]["num_affected_rows"] == 2


def test_repeated_landings_give_the_newest(spark, database):
    """Also within one run; names of the scope may come as a frame."""
    twice = [pull(1, title="old"), pull(1, updated="2024-01-09T00:00:00Z", title="new"), pull(2), pull(2)]
    names = [spark.createDataFrame([(n,)], "whatever string") for n in ("acme", "abe")]
    workflow.run_all(spark, database, landing(spark, twice, []), *names, at=AT)
    assert rows(spark.table(f"{database}.source_pulls"), "pull_number", "title") == [("1", "new"), ("2", "t2")]


def test_pages_of_an_organization(spark):
    one = landed_orgs(spark, ("acme", 7, [(1, "ann")], [(9, "zed")]), ("acme", 7, [(2, "bob"), (3, "cy")], []), ("beta", 8, [], []))
    bare = spark.createDataFrame([("acme", None, None, None), ("gamma", '{"id": 4}', None, "null")], workflow.KINDS["orgs"])
    made = orgs.org_snapshot(orgs.whole_orgs(one.unionByName(bare)), DAY)
    got = {r["org_name"]: (sorted(m["id"] for m in r["members"] or []), len(r["repos"] or []), r["metrics"]["member_count"]) for r in made.collect()}
    assert got == {"acme": (["1", "2", "3"], 1, 3), "beta": ([], 0, 0), "gamma": ([], 0, None)}
    broken = one.unionByName(spark.createDataFrame([("acme", None, "busy", None)], workflow.KINDS["orgs"]))
    with pytest.raises(Exception, match="unreadable members: busy"):
        orgs.org_snapshot(orgs.whole_orgs(broken), DAY).collect()
