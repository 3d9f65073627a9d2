import dataclasses
import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.incremental import fresh_records, high_water_marks, load, with_epoch
from tidemark.operators.policies import PULLS_IN_BLOCKS
from tidemark.operators.scope import UnknownNames, require_known, scope_pairs
from tidemark.plans import contributors, expectations, orgs, pulls, repos, users, workflow
from tidemark.sources import catalog
from tidemark.streaming.intake import merge_stream, newest_per_key

AT = datetime(2024, 3, 4, 5, 6, 7)
DAY = AT.date()


def org_text(org_id, members=(), listed=()):
    return (
        json.dumps({"id": org_id, "public_repos": len(listed), "owned_private_repos": 1, "other": {"x": 1}}),
        json.dumps([{"id": i, "login": n, "extra": 1} for i, n in members]),
        json.dumps([{"id": i, "name": n, "private": False, "pushed_at": "2024-01-01T00:00:00Z"} for i, n in listed]),
    )


def landed_orgs(spark, *records):
    return spark.createDataFrame(
        [(name, *org_text(i, members, listed)) for name, i, members, listed in records], workflow.KINDS["orgs"]
    )


def test_org_snapshot(spark):
    df = orgs.org_snapshot(landed_orgs(spark, ("acme", 7, [(1, "ann"), (2, "bob")], [(9, "zed"), (8, "abe")])), DAY)
    row = df.first().asDict(recursive=True)
    assert row["org_id"] == "7" and row["dt"] == DAY
    assert row["members"] == [{"id": "1", "name": "ann"}, {"id": "2", "name": "bob"}]
    assert row["metrics"] == {"public_repo_count": 2, "private_repo_count": 1, "member_count": 2}
    assert row["repos"][0] == {
        "id": "9", "name": "zed", "is_private": False, "is_fork": None, "is_archived": None,
        "time": {"pushed": datetime(2024, 1, 1), "created": None, "updated": None},
    }
    assert orgs.repo_names(df).first()["repo_names"] == ["abe", "zed"]
    assert rows(orgs.listed_repos(df), "repo_id", "repo_name") == [("8", "abe"), ("9", "zed")]
    empty = orgs.org_snapshot(landed_orgs(spark, ("none", 1, [], [])), DAY).first()
    assert empty["members"] == [] and empty["metrics"]["member_count"] == 0


def test_repo_snapshot(spark):
    body = {"id": 5, "watchers_count": 3, "forks_count": 1, "size": 9, "html_url": "h", "pulls_url": "p{/number}", "mirror_url": None}
    texts = spark.createDataFrame(
        [("7", "acme", "abe", json.dumps(body))], "org_id string, org_name string, repo_name string, repo string"
    )
    row = repos.repo_snapshot(texts, DAY).first()
    assert row["repo_id"] == "5" and row["metrics"]["watchers_count"] == 3 and row["metrics"]["network_count"] is None
    assert "urls" not in row
    assert repos.url_names(repos.repo_records(texts, DAY)).first()["url_names"] == ["html", "pulls"]


def contributor_page(*people):
    return json.dumps(
        [
            {"author": {"id": i, "login": n}, "weeks": [dict(zip("wadc", week)) for week in weeks], "total": 1}
            for i, n, weeks in people
        ]
    )


IDS = "org_id string, org_name string, repo_id string, repo_name string, page string"


def test_contributors(spark):
    week = 7 * 86400
    start = 1704067200  # Monday 2024-01-01
    page = contributor_page(
        (1, "ann", [(start, 1, 2, 3), (start + week, 0, 0, 0), (start + 2 * week, 4, 0, 1)]),
        (2, "bob", [(start, 0, 0, 0)]),
        (3, "cy", []),
    )
    df = contributors.contributor_rollup(
        contributors.contributor_records(spark.createDataFrame([("7", "acme", "5", "abe", page)], IDS), AT)
    )
    got = rows(df, "user_id", "first_week", "last_week", "activity.weeks", "activity.lines_added", "activity.commits")
    assert got == [
        ("1", date(2024, 1, 1), date(2024, 1, 15), 2, 5, 4),
        ("2", None, None, 0, 0, 0),
        ("3", None, None, 0, 0, 0),
    ]
    assert df.first()["api_request_time"] == AT


def pull(number, updated="2024-01-05T00:00:00Z", user=1, **more):
    return {
        "id": 100 + number, "number": number, "title": f"t{number}", "user": user and {"id": user},
        "labels": [], "created_at": "2024-01-01T00:00:00Z", "updated_at": updated, "closed_at": None, "merged_at": None, **more,
    }


def pull_frames(spark, pulls_, details=(), reviews=()):
    ids = ("7", "acme", "5", "abe")
    pages = spark.createDataFrame([(*ids, json.dumps(list(pulls_)))], IDS)
    keyed = "repo_id string, pull_number string, "
    detail = spark.createDataFrame([("5", str(n), json.dumps(d)) for n, d in details], keyed + "detail string")
    review = spark.createDataFrame([("5", str(n), json.dumps(r)) for n, r in reviews], keyed + "reviews string")
    return pages, detail, review


def test_pulls(spark):
    review = {"id": 9, "user": {"id": 4}, "state": "CHANGES_REQUESTED", "submitted_at": "2024-01-02T00:00:00Z"}
    pages, detail, reviews = pull_frames(
        spark,
        [
            pull(1, labels=[{"name": "bug"}, {"name": "ui"}], draft=True),
            pull(2, merged_at="2024-01-06T00:00:00Z"),
            pull(3, user=None),
            pull(4, updated="soon"),
            pull(5),
            pull(6),
            pull(7),
        ],
        [(1, {"comments": 1, "review_comments": 2, "commits": 3, "changed_files": 4})],
        [(1, [review]), (2, []), (5, [review, {**review, "user": None}]), (6, [{**review, "submitted_at": "x"}]), (7, "busy")],
    )
    detailed = pulls.with_details(
        pulls.pull_rows(pulls.pull_records(pages), AT), pulls.pull_details(detail), pulls.pull_reviews(reviews)
    )
    good, rejects = pulls.pull_facts(detailed)
    first, second = [r.asDict(recursive=True) for r in good.orderBy("pull_id").collect()]
    assert first["labels"] == ["bug", "ui"] and first["is_draft"] is True
    assert first["metrics"] == {"comment_count": 1, "review_comment_count": 2, "commit_count": 3, "changed_file_count": 4}
    assert first["reviews"] == [
        {"review_id": "9", "user_id": "4", "action": "changes requested", "submitted": datetime(2024, 1, 2)}
    ]
    assert second["labels"] is None and second["reviews"] is None and second["is_draft"] is False
    assert second["time"]["merged"] == datetime(2024, 1, 6) and second["time"]["closed"] is None
    assert rows(rejects, "pull_number", "reject_reason") == [
        ("3", "missing author"),
        ("4", "malformed updated time"),
        ("5", "missing reviewer"),
        ("6", "malformed review time"),
        ("7", "unreadable reviews"),
    ]


def test_marks_are_inclusive_by_day(spark):
    stored = spark.sql(
        "select 'o' org_id, 'r' repo_id, named_struct('updated', timestamp_ntz'2024-01-05 10:00:00') time"
    )
    marks = high_water_marks(stored, ("org_id", "repo_id"), "time.updated")
    records = spark.createDataFrame(
        [(1, "r", "2024-01-05T00:00:01Z"), (2, "r", "2024-01-04T23:59:59Z"), (3, "new", "1980-01-01T00:00:00Z"),
         (4, "r", "broken"), (5, "r", None)],
        "n int, repo_id string, updated_at string",
    ).withColumn("org_id", F.lit("o"))
    fresh = fresh_records(records, marks, ("org_id", "repo_id"), F.col("updated_at"))
    assert rows(fresh, "n") == [(1,), (3,), (4,), (5,)]
    known = spark.createDataFrame([("o", "r"), ("o", "empty")], "org_id string, repo_id string")
    assert rows(with_epoch(known, marks, ("org_id", "repo_id")), "repo_id", "mark") == [
        ("empty", datetime(1970, 1, 1)), ("r", datetime(2024, 1, 5, 10)),
    ]
    assert load(records, "all").count() == 5
    assert load(records, "sample", key="n", sample_size=2).count() == 2
    for bad in ("new", "sample"):
        with pytest.raises(ValueError):
            load(records, bad)


def doc(title, sources, issues):
    wrap = lambda v: {"const": v}
    inner = {"supported_data_sources": wrap(sources), "data_quality_issues": wrap(issues)}
    return json.dumps({"title": title, "properties": {"metadata": {"properties": inner}}})


def test_expectations(spark):
    core = expectations.core_expectations(
        spark.createDataFrame(
            [(doc("Expect Column Max", ["Spark", "pandas"], ["Schema"]),), (doc("Expect X", None, []),)], "value string"
        )
    )
    assert rows(core) == [
        ("expect_column_max", ["pandas", "spark"], ["schema"], False),
        ("expect_x", None, [], False),
    ]
    engines = {"PandasExecutionEngine": True, "SparkDFExecutionEngine": False, "SqlA": True, "SqlB": True}
    legacy = expectations.legacy_expectations(
        spark.createDataFrame(
            [(json.dumps({"expect_x": {"execution_engines": engines}, "expect_old": {"execution_engines": engines}, "bare": {}}),)],
            "value string",
        )
    )
    assert rows(legacy, "expectation_name", "data_sources")[1] == ("expect_old", ["pandas", "sql", "sql"])
    both = expectations.with_legacy(core, legacy)
    assert [(r[0], r["deprecated"]) for r in both.collect()] == [
        ("expect_column_max", False), ("expect_x", False), ("bare", True), ("expect_old", True),
    ]


def test_users_of_the_latest_day(spark):
    old = orgs.org_snapshot(landed_orgs(spark, ("acme", 7, [(1, "old"), (3, "gone")], [])), date(2024, 1, 1))
    new = orgs.org_snapshot(
        landed_orgs(spark, ("acme", 7, [(1, "ann")], []), ("beta", 8, [(1, "ann"), (2, "bob")], [])), date(2024, 1, 2)
    )
    assert rows(users.current_users(old.unionByName(new))) == [("1", "ann"), ("2", "bob")]


def test_records_without_identity_are_errors(spark):
    with pytest.raises(Exception, match="no id for organization: acme"):
        orgs.org_snapshot(spark.createDataFrame([("acme", "{}", "[]", "[]")], workflow.KINDS["orgs"]), DAY).collect()
    with pytest.raises(Exception, match="no title in document: busy"):
        expectations.core_expectations(spark.createDataFrame([("busy",)], "value string")).collect()


def test_scope(spark):
    listed = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z")], "org_name string, repo_name string")
    names = lambda c, *v: spark.createDataFrame([(n,) for n in v], f"{c} string")
    assert rows(scope_pairs(listed, names("org_name", "a", "c"), names("repo_name", "x", "z"))) == [("a", "x")]
    require_known(names("org_name", "a"), listed, ["org_name"])
    with pytest.raises(UnknownNames, match="nobody"):
        require_known(names("org_name", "a", "nobody"), listed, ["org_name"])


def landing(spark, pulls_, members, details=(), reviews=(), docs=()):
    make = lambda kind, data: spark.createDataFrame(list(data), workflow.KINDS[kind])
    week = [(1704067200, 1, 1, 1)]
    return workflow.Landing(
        orgs=landed_orgs(spark, ("acme", 7, members, [(5, "abe"), (6, "other")]), ("beta", 8, [], [(9, "abe2")])),
        repos=make("repos", [("acme", "abe", '{"id": 5, "forks_count": 2}'), ("acme", "other", '{"id": 6}')]),
        contributors=make("contributors", [("acme", "abe", contributor_page((1, "ann", week))), ("acme", "abe", '[{"weeks": []}]')]),
        pulls=make("pulls", [("acme", "abe", json.dumps(list(pulls_))), ("acme", "other", json.dumps([pull(77)]))]),
        details=make("details", [("acme", "abe", str(n), json.dumps(d)) for n, d in details]),
        reviews=make("reviews", [("acme", "abe", str(n), json.dumps(r)) for n, r in reviews]),
        expectations=make("expectations", [(d,) for d in docs]),
    )


def test_run_all_twice(spark, database, tmp_path):
    args = (["acme"], ["abe", "unlisted"])
    first = landing(spark, [pull(1), pull(2), pull(3, user=None)], [(1, "ann")], docs=[doc("Expect A", ["x"], []), doc("Expect B", ["x"], [])])
    counts = {r["table_name"]: r for r in workflow.run_all(spark, database, first, *args, at=AT).collect()}
    assert {t: r["num_inserted_rows"] for t, r in counts.items()} == {
        "source_orgs": 1, "source_repos": 1, "source_contributors": 1, "source_pulls": 2, "expectations": 2, "users": 0,
    }
    assert counts["source_pulls"]["num_rejected_rows"] == 1
    assert counts["source_contributors"]["num_rejected_rows"] == 1
    assert rows(spark.table(f"{database}.users")) == [("1", "ann")]

    again = landing(
        spark,
        [pull(1), pull(2, updated="2024-01-06T00:00:00Z", title="newer"), pull(4, updated="2023-01-01T00:00:00Z")],
        [(1, "anna"), (2, "bob")],
        docs=[doc("Expect A", ["x", "y"], [])],
    )
    counts = {r["table_name"]: r for r in workflow.run_all(spark, database, again, *args, at=AT).collect()}
    changes = {t: (r["num_updated_rows"], r["num_inserted_rows"]) for t, r in counts.items()}
    assert changes == {
        "source_orgs": (1, 0),  # the same day's snapshot is replaced
        "source_repos": (1, 0),
        "source_contributors": (0, 0),  # no later week
        "source_pulls": (1, 0),  # pull 4 lies before the mark
        "expectations": (2, 0),  # one changed, one deprecated
        "users": (1, 1),
    }
    stored = spark.table(f"{database}.source_pulls")
    assert rows(stored, "pull_number", "title") == [("1", "t1"), ("2", "newer")]
    assert rows(spark.table(f"{database}.users")) == [("1", "anna"), ("2", "bob")]
    # A full load takes in what the mark had held back.
    full = workflow.run_all(spark, database, again, *args, at=AT, mode="all").filter("table_name = 'source_pulls'")
    assert full.first()["num_inserted_rows"] == 1
    with pytest.raises(UnknownNames):
        workflow.run_all(spark, database, again, ["nobody"], ["abe"], at=AT)
    assert workflow.delete_all(spark, database).filter("dropped").count() == 6
    assert not catalog.exists(spark, f"{database}.source_pulls")


def test_landing_from_files(spark, database, tmp_path):
    data = landing(spark, [pull(1)], [(1, "ann")], docs=[doc("Expect A", ["x"], [])])
    for kind in workflow.KINDS:
        getattr(data, kind).write.json(f"{tmp_path}/{kind}")
    counts = workflow.run_all(spark, database, workflow.read_landing(spark, str(tmp_path)), ["acme"], ["abe"], at=AT, mode="sample")
    assert counts.filter("table_name = 'source_pulls'").first()["num_inserted_rows"] == 1


def test_stream_takes_each_file_once(spark, database, tmp_path):
    from tidemark.operators.policies import USERS

    name = f"{database}.users"
    land = lambda v: spark.createDataFrame(v, "user_id string, user_name string, at int").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    transform = lambda df: df

    def take_in():
        return merge_stream(
            spark, f"{tmp_path}/in", "user_id string, user_name string, at int", transform, name, USERS, "at", f"{tmp_path}/cp"
        )

    land([("1", "a", 1), ("1", "b", 2), ("2", "c", 1)])
    take_in()
    assert rows(spark.table(name), "user_id", "user_name") == [("1", "b"), ("2", "c")]
    land([("2", "d", 2), ("3", "e", 1)])
    query = take_in()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert rows(spark.table(name), "user_id", "user_name") == [("1", "b"), ("2", "d"), ("3", "e")]


def test_newest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", None), (2, "d", None)], "k int, v string, at int")
    assert rows(newest_per_key(df, ("k",), "at")) == [(1, "b", 3), (2, "d", None)]


def test_newest_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, "b", 3), (1, "c", 2)], "k int, v string, at int")
    assert rows(newest_per_key(df, ("k",), "at")) == [(None, "a", 1), (None, "a", 1), (1, "b", 3)]


def test_reviews_in_several_pages(spark):
    review = {"id": 9, "user": {"id": 4}, "state": "APPROVED", "submitted_at": "2024-01-02T00:00:00Z"}
    pages, detail, reviews = pull_frames(spark, [pull(1), pull(2)], [], [(1, [review]), (1, [{**review, "id": 10}, {**review, "id": 11}]), (2, "busy"), (2, [review])])
    detailed = pulls.with_details(
        pulls.pull_rows(pulls.pull_records(pages), AT), pulls.pull_details(detail), pulls.pull_reviews(reviews)
    )
    good, rejects = pulls.pull_facts(detailed)
    (one,) = good.collect()
    assert one["pull_number"] == "1" and sorted(r["review_id"] for r in one["reviews"]) == ["10", "11", "9"]
    assert rows(rejects, "pull_number", "reject_reason") == [("2", "unreadable reviews")]


def test_unreadable_records_are_set_aside(spark):
    broken = [pull(1, id="x1"), pull(2), pull(3), pull(4), {**pull(5), "number": None}]
    pages, _, reviews = pull_frames(spark, broken)
    detail = spark.createDataFrame(
        [("5", "2", "not json"), ("5", "3", '{"commits": "many"}'), ("5", "4", '{"commits": "7"}')], "repo_id string, pull_number string, detail string"
    )
    detailed = pulls.with_details(
        pulls.pull_rows(pulls.pull_records(pages), AT), pulls.pull_details(detail), pulls.pull_reviews(reviews)
    )
    good, rejects = pulls.pull_facts(detailed)
    assert rows(good, "pull_id", "metrics.commit_count") == [("104", 7)]
    assert rows(rejects, "pull_id", "reject_reason") == [
        (None, "missing id"), ("102", "unreadable details"), ("103", "unreadable details"), ("105", "missing number"),
    ]
    page = contributor_page((1, "ann", [(1704067200, 1, 2, 3), (1704067200, "many", 2, 3)]), (2, "bob", [(1704067200, "4", 0, 0)]))
    records = contributors.contributor_records(spark.createDataFrame([("7", "acme", "5", "abe", page)], IDS), AT)
    judged = records.withColumn("reason", contributors.contributor_reject_reason())
    assert rows(judged, "user_id", "reason") == [("1", "unreadable week"), ("2", None)]
    texts = lambda v: spark.createDataFrame([("7", "acme", "abe", json.dumps({"id": 5, "forks_count": v}))], "org_id string, org_name string, repo_name string, repo string")
    assert repos.repo_snapshot(texts("12"), DAY).first()["metrics"]["forks_count"] == 12
    for bad in ("many", 3_000_000_000):
        with pytest.raises(Exception, match="unreadable forks_count"):
            repos.repo_snapshot(texts(bad), DAY).collect()


def test_run_without_details_and_members(spark, database):
    data = landing(spark, [pull(1), pull(2)], [])
    data = dataclasses.replace(data, details=None, reviews=None, expectations=None, contributors=None)
    blocks = {pulls.TABLE: PULLS_IN_BLOCKS}
    counts = {r["table_name"]: r for r in workflow.run_all(spark, database, data, ["acme"], ["abe"], at=AT, specs=blocks).collect()}
    assert counts["source_pulls"]["num_inserted_rows"] == 2 and counts["users"]["num_affected_rows"] == 0
    assert rows(spark.table(f"{database}.source_pulls"), "pull_number", "pull_block") == [("1", 0), ("2", 0)]


def test_sample_is_taken_per_repository(spark):
    df = spark.createDataFrame([(r, i) for r in "ab" for i in range(5)], "repo string, n int")
    picked = load(df, "sample", key="n", groups=("repo",), sample_size=2)
    assert rows(picked.groupBy("repo").count()) == [("a", 2), ("b", 2)]
