"""What reaches the scans, and which joins are planned."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.incremental import fresh_records, high_water_marks
from tidemark.operators.merge import MergeSpec, merge_actions, merge_decisions, merge_plan
from tidemark.operators.policies import CONTRIBUTORS, EXPECTATIONS, PULLS, USERS
from tidemark.plans import pulls as pull_plans
from tidemark.plans import workflow
from tidemark.plans.expectations import core_expectations, legacy_expectations, with_legacy
from tidemark.plans.users import current_users
from tidemark.queries.catalogue import legacy_docs, schema_docs
from tidemark.queries.tables import landing_of
from tidemark.sources import catalog
from tidemark.sources.staging import stage


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    df.collect()
    return [line for line in executed(df).splitlines() if "FileScan" in line]


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)(?=\n|$)", executed(df), flags=re.M)


@pytest.fixture
def pulls(spark, tmp_path):
    df = spark.range(100).select(
        F.lit("o").alias("org_id"),
        (F.col("id") % 5).cast("string").alias("repo_id"),
        F.col("id").cast("string").alias("pull_id"),
        F.lit("long text").alias("title"),
        F.struct(F.lit("x").alias("created"), F.col("id").alias("updated")).alias("time"),
    )
    df.write.parquet(f"{tmp_path}/pulls")
    return spark.read.parquet(f"{tmp_path}/pulls")


def test_marks_read_one_nested_field(pulls):
    marks = high_water_marks(pulls.filter("repo_id = '1'"), ("org_id", "repo_id"), "time.updated")
    plan = executed(marks)
    assert "EqualTo(repo_id,1)" in plan
    assert read_schemas(marks) == ["struct<org_id:string,repo_id:string,time:struct<updated:bigint>>"]


def test_actions_read_keys_and_conditions_only(pulls):
    actions = merge_actions(pulls, pulls, PULLS)
    assert "title" not in executed(actions) and "created" not in executed(actions)


def test_a_broadcast_source_leaves_the_target_unshuffled(spark, pulls):
    spec = MergeSpec(PULLS.keys, PULLS.update_when)
    merged = merge_plan(pulls, pulls.filter("pull_id < '2'"), spec, broadcast_source=True)
    wide = [line for line in executed(merged).splitlines() if "Exchange hashpartitioning" in line]
    # Only the keys that met the source are shuffled, to make them distinct.
    assert len(wide) <= 1
    assert "BroadcastHashJoin" in executed(merged)


def exchanges(df) -> list[str]:
    """Hash exchanges of the plan as it ran; one that is used again counts once."""
    df.collect()
    final = executed(df).split("== Initial Plan ==")[0]
    return re.findall(r"(?<!Reused)Exchange hashpartitioning\([^)]*\)", final)


def test_a_shuffled_source_is_shuffled_once(spark, pulls, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_plan(pulls, pulls.filter("pull_id < '2'"), MergeSpec(PULLS.keys, PULLS.update_when))
        # One exchange of either side: the target's keys do not move a second time.
        assert len(exchanges(merged)) == 2
        assert "SortMergeJoin" in executed(merged) or "ShuffledHashJoin" in executed(merged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("spec", [PULLS, USERS, EXPECTATIONS, CONTRIBUTORS], ids=["M4", "M6", "M5", "M3"])
def test_decisions_take_one_shuffle(spark, tmp_path, spec):
    """Both sides' keys and condition columns in one exchange, nothing else of the rows."""
    df = spark.range(200).select(
        *[F.col("id").cast("string").alias(k) for k in dict.fromkeys((*spec.keys, "user_name"))],
        F.struct(F.col("id").alias("updated"), F.lit("x").alias("created")).alias("time"),
        F.array(F.lit("a")).alias("data_sources"), F.array(F.lit("b")).alias("data_quality_issues"),
        F.lit(False).alias("deprecated"), F.current_date().alias("last_week"), F.lit("long text").alias("title"),
    ).repartition(3)
    df.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    decided = merge_decisions(df, df.filter("time.updated % 2 = 0"), spec)
    assert rows(decided.groupBy("_action").count()) == ([("keep", 100), ("soft_delete", 100)] if spec is EXPECTATIONS else [("keep", 200)])
    assert len(exchanges(decided)) == 1 and "Join" not in executed(decided)
    assert "title" not in executed(decided) and "created" not in executed(decided)


def test_a_hot_group_is_split_among_tasks(spark, tmp_path):
    """A third of the records in one repository: AQE splits that partition of the join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in conf if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        repo = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97)
        updated = F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1).cast("string"), F.lit("T00:00:00Z"))
        records = spark.range(0, 60_000, 1, 8).select(
            "id", repo.alias("repo_id"), updated.alias("updated_at"), F.md5(F.col("id").cast("string")).alias("title")
        )
        marks = spark.range(97).select(F.col("id").alias("repo_id"), F.expr("timestamp_ntz'2024-01-05 00:00:00'").alias("mark"))
        fresh = fresh_records(records, marks, ("repo_id",), F.col("updated_at"))
        assert len(fresh.collect()) == sum(i % 9 + 1 >= 5 for i in range(60_000))
        assert "skew=true" in executed(fresh)
        assert fresh.filter("updated_at < '2024-01-05'").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_users_open_the_latest_day_only(spark, database):
    member = F.array(F.struct(F.col("id").cast("string").alias("id"), F.lit("n").alias("name")))
    days = spark.range(30).select(
        member.alias("members"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("dt")
    )
    catalog.create_as(days, f"{database}.orgs", ("dt",))
    users = current_users(spark.table(f"{database}.orgs"))
    assert rows(users) == [("29", "n")]
    assert re.search(r"PartitionFilters: \[[^\]]*dt[^\]]*[Ss]ubquery", executed(users))


def test_partitioned_merge_lists_touched_folders(spark, database):
    from tidemark.operators.sizing import listed_partitions, only_partitions

    df = spark.range(40).select("id", (F.col("id") % 8).alias("p"), (F.col("id") % 2).alias("q"))
    catalog.create_as(df, f"{database}.t", ("p", "q"))
    listed = listed_partitions(df.filter("p = 3"), ("p", "q"))
    picked = only_partitions(spark.table(f"{database}.t"), listed, ("p", "q"))
    assert picked.count() == 5
    plan = executed(picked)
    assert "PartitionFilters: []" not in plan and "PushedFilters: []" in plan


@pytest.fixture
def parts(spark, tmp_path):
    """A folder whose ``part`` is one file of one row group."""
    made = spark.range(100).selectExpr("id as p_partkey", "'a b' as p_name", "cast(id as int) as p_size")
    made.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_expectation_texts_are_parsed_once(spark, parts):
    core = core_expectations(schema_docs(spark, parts))
    assert core._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert core.filter("expectation_name = 'expect_a_b_7'").count() == 1


def test_documents_of_one_row_group_are_dealt_to_all_cores(spark, parts):
    for docs in (schema_docs(spark, parts), legacy_docs(spark, parts)):
        tasks = docs.select(F.spark_partition_id().alias("task"), "value")
        assert tasks.select("task").distinct().count() > 4
        assert tasks.count() == 100


def test_both_catalogues_are_parsed_before_they_are_sorted(spark, parts):
    both = with_legacy(core_expectations(schema_docs(spark, parts)), legacy_expectations(legacy_docs(spark, parts)))
    assert both.count() == 166
    assert "json" not in both._jdf.queryExecution().optimizedPlan().toString().lower()


def test_judged_pulls_are_read_not_worked_out_again(spark):
    page = '[{"id": 1, "number": 1, "user": {"id": 7}, "updated_at": "2024-01-01T00:00:00Z"}, {"id": 2, "number": 2}]'
    ids = "org_id string, org_name string, repo_id string, repo_name string"
    pages = spark.createDataFrame([("1", "org", "2", "repo", page)], f"{ids}, page string")
    empty = lambda body: spark.createDataFrame([], f"repo_id string, pull_number string, {body} string")
    rows_of_run = pull_plans.pull_rows(pull_plans.pull_records(pages))
    detailed = pull_plans.with_details(
        rows_of_run, pull_plans.pull_details(empty("detail")), pull_plans.pull_reviews(empty("reviews"))
    )
    facts, bad = workflow._judged_pulls(detailed, stage)
    assert rows(facts, "pull_id") == [("1",)]
    assert rows(bad, "pull_id", "reject_reason") == [("2", "missing author")]
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and "exists" not in plan
    assert "exists" not in bad._jdf.queryExecution().optimizedPlan().toString()


def test_landed_orders_of_one_row_group_are_dealt_to_all_cores(spark, parts):
    made = {
        "nation": ["id as n_nationkey", "'n' || id as n_name", "0L as n_regionkey"],
        "region": ["id as r_regionkey", "'r' || id as r_name"],
        "customer": ["id as c_custkey", "id % 10 as c_nationkey"],
        "events": ["id as user_id", "timestamp_ntz '2024-01-01 00:00:00' as ts"],
        "orders": ["id as o_orderkey", "id % 100 as o_custkey", "'O' as o_orderstatus", "'x' as o_orderpriority", "timestamp_ntz '2024-01-01 00:00:00' as o_orderdate"],
    }
    for name, columns in made.items():
        spark.range(10_000 if name == "orders" else 100).selectExpr(*columns).coalesce(1).write.parquet(f"{parts}/{name}.parquet")
    landing = landing_of(spark, parts)
    for texts in (landing.pulls, landing.details):
        assert texts.count() == 10_000
        assert "RoundRobinPartitioning" in executed(texts)
