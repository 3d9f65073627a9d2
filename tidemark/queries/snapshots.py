"""Snapshots of organizations and repositories, and the users derived from them.

Organizations are blocks of 100 customer keys, so their number grows with the data
while each one's lists stay bounded.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators.merge import ACTION, merge_plan
from tidemark.operators.policies import ORG_SNAPSHOT, REPO_SNAPSHOT, USERS
from tidemark.operators.scope import scope_pairs, unknown_names
from tidemark.operators.select import select_ordered
from tidemark.plans.orgs import listed_repos, org_snapshot, repo_names, whole_orgs
from tidemark.plans.repos import repo_snapshot
from tidemark.plans.users import current_users
from tidemark.queries.registry import query, table
from tidemark.sources.staging import stage

DAY = date(2024, 1, 2)


def member_snapshots(spark, sf_dir):
    """Two days of member lists. Every tenth customer is in two organizations, and one
    organization in five was not loaded on the second day."""
    home = F.col("c_nationkey")
    orgs = F.when(F.col("c_custkey") % 10 == 0, F.array(home, (home + 1) % 25)).otherwise(F.array(home))
    days = F.array(
        F.struct(F.lit(date(2024, 1, 1)).alias("dt"), F.concat("c_name", F.lit(" (old)")).alias("name")),
        F.struct(F.lit(DAY).alias("dt"), F.col("c_name").alias("name")),
    )
    block = F.floor(F.col("c_custkey") / 100).cast("string")
    rows = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", F.explode(orgs).alias("org"))
        .select("c_custkey", "org", F.explode(days).alias("day"))
        .filter((F.col("day.dt") < F.lit(DAY)) | (F.col("org") % 5 != 4))
    )
    person = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("day.name").alias("name"))
    helper = F.struct(F.concat(F.lit("helper-"), block).alias("id"), F.concat(F.lit("Helper "), block).alias("name"))
    return rows.select(
        F.col("org").cast("string").alias("org_id"), F.col("day.dt").alias("dt"), F.array(person, helper).alias("members")
    )


@query(
    """
    WITH seats AS (
        SELECT c_custkey, c_name, c_nationkey AS org FROM customer
        UNION ALL
        SELECT c_custkey, c_name, (c_nationkey + 1) % 25 FROM customer WHERE c_custkey % 10 = 0
    ), current AS (SELECT * FROM seats WHERE org % 5 <> 4)
    SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name FROM current
    UNION
    SELECT 'helper-' || CAST(c_custkey // 100 AS VARCHAR), 'Helper ' || CAST(c_custkey // 100 AS VARCHAR) FROM current
    """
)
def users_latest_snapshot(spark, sf_dir):
    """Members of the latest day, once each."""
    return current_users(member_snapshots(spark, sf_dir))


@query(
    """
    WITH t AS (
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               CASE WHEN c_custkey % 5 = 0 THEN 'Old ' || c_name ELSE c_name END AS user_name
        FROM customer WHERE c_custkey % 7 <> 0
    ), s AS (
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name FROM customer WHERE c_custkey % 11 <> 0
    )
    SELECT coalesce(t.user_id, s.user_id) AS user_id,
           CASE WHEN s.user_id IS NULL THEN t.user_name ELSE s.user_name END AS user_name,
           CASE WHEN t.user_id IS NULL THEN 'insert'
                WHEN t.user_name <> s.user_name THEN 'update' ELSE 'keep' END AS action
    FROM t FULL OUTER JOIN s ON t.user_id = s.user_id
    """
)
def users_merge(spark, sf_dir):
    """M6: renamed users overwritten, new ones added."""
    people = table(spark, sf_dir, "customer").withColumn("user_id", F.col("c_custkey").cast("string"))
    old = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("Old "), "c_name")).otherwise(F.col("c_name"))
    target = people.filter("c_custkey % 7 <> 0").select("user_id", old.alias("user_name"))
    source = people.filter("c_custkey % 11 <> 0").select("user_id", F.col("c_name").alias("user_name"))
    return merge_plan(target, source, USERS).withColumnRenamed(ACTION, "action")


def _or_empty(df, column):
    return F.coalesce(F.col(column), F.array().cast(df.schema[column].dataType))


def landed_orgs(spark, sf_dir):
    """Organization texts as received, with members, repositories or both. Lists hold at most one block of 100 keys, and the
    sets collapse copies before the shuffle."""
    block = lambda key: F.floor(F.col(key) / 100)
    members = (
        table(spark, sf_dir, "customer")
        .filter("c_custkey is not null")
        .groupBy(block("c_custkey").alias("org"))
        .agg(F.collect_set(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("login"))).alias("members"))
    )
    repo = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("repo-"), F.col("p_partkey").cast("string")).alias("name"),
        (F.col("p_size") % 2 == 0).alias("private"),
        (F.col("p_size") % 3 == 0).alias("fork"),
        (F.col("p_size") % 5 == 0).alias("archived"),
        F.lit("2024-01-01T10:00:00Z").alias("pushed_at"),
        F.lit("2020-05-05T00:00:00Z").alias("created_at"),
        F.date_format(F.date_add(F.lit(date(2021, 1, 1)), F.col("p_size")), "yyyy-MM-dd'T'00:00:00'Z'").alias("updated_at"),
    )
    repos = (
        table(spark, sf_dir, "part")
        .filter("p_partkey is not null")
        .groupBy(block("p_partkey").alias("org"))
        .agg(F.collect_set(repo).alias("repos"))
    )
    hidden = F.size(F.filter("repos", lambda r: r["private"]))
    org = F.struct(
        F.col("org").alias("id"),
        (F.size("repos") - hidden).alias("public_repos"),
        hidden.alias("owned_private_repos"),
    )
    every = members.join(repos, "org", "full").withColumns(
        {"members": _or_empty(members, "members"), "repos": _or_empty(repos, "repos")}
    )
    return every.select(
        F.concat(F.lit("org-"), F.col("org").cast("string")).alias("org_name"),
        F.to_json(org).alias("org"),
        F.to_json("members").alias("members"),
        F.to_json("repos").alias("repos"),
    )


@query(
    """
    WITH m AS (SELECT c_custkey // 100 AS org, count(*) AS members FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1),
    r AS (
        SELECT p_partkey // 100 AS org, count(*) AS repos,
               count(*) FILTER (WHERE p_size % 2 = 0) AS hidden,
               count(*) FILTER (WHERE p_size % 5 = 0) AS archived,
               min('repo-' || CAST(p_partkey AS VARCHAR)) AS first_repo,
               max(TIMESTAMP '2021-01-01' + p_size * INTERVAL 1 DAY) AS last_update
        FROM part WHERE p_partkey IS NOT NULL GROUP BY 1
    )
    SELECT CAST(org AS VARCHAR) AS org_id, 'org-' || CAST(org AS VARCHAR) AS org_name,
           CAST(coalesce(members, 0) AS INTEGER) AS member_count,
           CAST(coalesce(repos - hidden, 0) AS INTEGER) AS public_repo_count,
           CAST(coalesce(hidden, 0) AS INTEGER) AS private_repo_count,
           CAST(coalesce(archived, 0) AS INTEGER) AS archived_count,
           first_repo, last_update, DATE '2024-01-02' AS dt
    FROM m FULL JOIN r USING (org)
    """
)
def org_snapshot_flat(spark, sf_dir):
    """Organization snapshots parsed from nested texts."""
    orgs = org_snapshot(landed_orgs(spark, sf_dir), DAY)
    return orgs.select(
        "org_id",
        "org_name",
        "metrics.member_count",
        "metrics.public_repo_count",
        "metrics.private_repo_count",
        F.size(F.filter("repos", lambda r: r["is_archived"])).alias("archived_count"),
        F.array_min(F.transform("repos", lambda r: r["name"])).alias("first_repo"),
        F.array_max(F.transform("repos", lambda r: r["time"]["updated"])).alias("last_update"),
        "dt",
    )


@query(
    """
    WITH m AS (SELECT DISTINCT c_custkey // 100 AS org FROM customer WHERE c_custkey IS NOT NULL),
    r AS (SELECT p_partkey // 100 AS org,
                 string_agg('repo-' || CAST(p_partkey AS VARCHAR), ',' ORDER BY 'repo-' || CAST(p_partkey AS VARCHAR)) AS names
          FROM part WHERE p_partkey IS NOT NULL GROUP BY 1)
    SELECT CAST(org AS VARCHAR) AS org_id, coalesce(names, '') AS repo_names FROM m FULL JOIN r USING (org)
    """
)
def org_repo_names(spark, sf_dir):
    """O2: each organization's repository names, sorted."""
    orgs = org_snapshot(landed_orgs(spark, sf_dir), DAY)
    return repo_names(orgs).select("org_id", F.array_join("repo_names", ",").alias("repo_names"))


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS repo_id, 'org-' || CAST(p_partkey // 100 AS VARCHAR) AS org_name,
           p_size AS watchers_count, CAST(p_partkey % 100 AS INTEGER) AS open_issues_count,
           CAST(floor(p_retailprice) AS INTEGER) AS stargazers_count,
           CAST(length(p_name) AS INTEGER) AS subscribers_count,
           CAST(NULL AS INTEGER) AS network_count, CAST(p_partkey % 7 AS INTEGER) AS forks_count,
           DATE '2024-01-02' AS dt
    FROM part
    """
)
def repo_snapshot_flat(spark, sf_dir):
    """Repository counters parsed from texts; URLs left out."""
    key = F.col("p_partkey")
    body = F.struct(
        key.alias("id"),
        F.col("p_size").alias("watchers_count"),
        (key % 100).alias("open_issues_count"),
        F.floor("p_retailprice").alias("stargazers_count"),
        F.length("p_name").alias("subscribers_count"),
        (key % 7).alias("forks_count"),
        F.concat(F.lit("https://example.org/r/"), key.cast("string"), F.lit("/pulls{/number}")).alias("pulls_url"),
    )
    block = F.floor(key / 100).cast("string")
    texts = table(spark, sf_dir, "part").select(
        block.alias("org_id"),
        F.concat(F.lit("org-"), block).alias("org_name"),
        F.col("p_name").alias("repo_name"),
        F.to_json(body).alias("repo"),
    )
    return repo_snapshot(texts, DAY).select("repo_id", "org_name", "metrics.*", "dt")


@query(
    """
    WITH daily AS (
        SELECT CAST(l_suppkey AS VARCHAR) AS org_id, CAST(l_shipdate AS DATE) AS dt,
               count(*) AS repos, count(*) FILTER (WHERE l_returnflag = 'A') AS seen
        FROM lineitem GROUP BY 1, 2
    ), t AS (SELECT org_id, seen AS repo_count, dt FROM daily WHERE dt < DATE '1999-01-01'),
    s AS (SELECT org_id, repos AS repo_count, dt FROM daily WHERE dt >= DATE '1998-07-01')
    SELECT coalesce(t.org_id, s.org_id) AS org_id, coalesce(t.dt, s.dt) AS dt,
           coalesce(s.repo_count, t.repo_count) AS repo_count,
           CASE WHEN t.org_id IS NULL THEN 'insert' WHEN s.org_id IS NULL THEN 'keep' ELSE 'update' END AS action
    FROM t FULL OUTER JOIN s ON t.org_id = s.org_id AND t.dt = s.dt
    """
)
def snapshot_merge_org(spark, sf_dir):
    """M1: a day's organization snapshot replaces an earlier one of that day."""
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("org_id"), F.to_date("l_shipdate").alias("dt"))
        .agg(F.count("*").alias("repos"), F.count_if(F.col("l_returnflag") == "A").alias("seen"))
    )
    daily = stage(daily, "daily-orgs")  # aggregated once for both sides of the merge
    target = daily.filter("dt < DATE '1999-01-01'").select("org_id", F.col("seen").alias("repo_count"), "dt")
    source = daily.filter("dt >= DATE '1998-07-01'").select("org_id", F.col("repos").alias("repo_count"), "dt")
    return merge_plan(target, source, ORG_SNAPSHOT).withColumnRenamed(ACTION, "action")


@query(
    """
    WITH daily AS (
        SELECT CAST(l_suppkey AS VARCHAR) AS org_id, CAST(l_partkey AS VARCHAR) AS repo_id,
               CAST(l_shipdate AS DATE) AS dt, CAST(sum(l_quantity) AS BIGINT) AS watchers, count(*) AS lines
        FROM lineitem GROUP BY 1, 2, 3
    ), t AS (SELECT org_id, repo_id, lines AS watchers, dt FROM daily WHERE dt < DATE '1999-01-01'),
    s AS (SELECT org_id, repo_id, watchers, dt FROM daily WHERE dt >= DATE '1998-07-01')
    SELECT coalesce(t.org_id, s.org_id) AS org_id, coalesce(t.repo_id, s.repo_id) AS repo_id,
           coalesce(t.dt, s.dt) AS dt, coalesce(s.watchers, t.watchers) AS watchers,
           CASE WHEN t.org_id IS NULL THEN 'insert' WHEN s.org_id IS NULL THEN 'keep' ELSE 'update' END AS action
    FROM t FULL OUTER JOIN s ON t.org_id = s.org_id AND t.repo_id = s.repo_id AND t.dt = s.dt
    """
)
def snapshot_merge_repo(spark, sf_dir):
    """M2: the same for repositories, on three keys."""
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_suppkey").cast("string").alias("org_id"),
            F.col("l_partkey").cast("string").alias("repo_id"),
            F.to_date("l_shipdate").alias("dt"),
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("watchers"), F.count("*").alias("lines"))
    )
    daily = stage(daily, "daily-repos")
    keys = ["org_id", "repo_id"]
    target = daily.filter("dt < DATE '1999-01-01'").select(*keys, F.col("lines").alias("watchers"), "dt")
    source = daily.filter("dt >= DATE '1998-07-01'").select(*keys, "watchers", "dt")
    return merge_plan(target, source, REPO_SNAPSHOT).withColumnRenamed(ACTION, "action")


def supplier_repos(spark, sf_dir):
    """Suppliers as repositories of their nations."""
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("org_name"), F.col("s_name").alias("repo_name")
    )


@query(
    """
    SELECT DISTINCT n_name AS org_name, s_name AS repo_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_name IN (SELECT n_name FROM nation WHERE n_regionkey IN (1, 3))
      AND s_name IN (SELECT s_name FROM supplier WHERE s_acctbal > 2000)
    """,
    name="scope_pairs",
)
def scope_pairs_listed(spark, sf_dir):
    """Configured organizations and repositories, where the one lists the other."""
    orgs = table(spark, sf_dir, "nation").filter("n_regionkey IN (1, 3)").select(F.col("n_name").alias("org_name"))
    repos = table(spark, sf_dir, "supplier").filter("s_acctbal > 2000").select(F.col("s_name").alias("repo_name"))
    return scope_pairs(supplier_repos(spark, sf_dir), orgs, repos)


@query(
    """
    SELECT DISTINCT CASE WHEN s_suppkey % 4 = 0 THEN 'No such ' || s_name ELSE s_name END AS repo_name
    FROM supplier WHERE s_suppkey % 4 = 0
    """
)
def scope_unknown(spark, sf_dir):
    """requested names the source does not list."""
    asked = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("No such "), "s_name")).otherwise(F.col("s_name"))
    requested = table(spark, sf_dir, "supplier").select(asked.alias("repo_name"))
    return unknown_names(requested, supplier_repos(spark, sf_dir), ["repo_name"])


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS repo_id, 'repo-' || CAST(p_partkey AS VARCHAR) AS repo_name,
           'org-' || CAST(p_partkey // 100 AS VARCHAR) AS org_name
    FROM part WHERE p_partkey IS NOT NULL
    """
)
def listed_repositories(spark, sf_dir):
    """One row per repository of a snapshot."""
    orgs = org_snapshot(landed_orgs(spark, sf_dir), DAY)
    return select_ordered(listed_repos(orgs), ["repo_id", "repo_name", "org_name"])[0]


@query(
    """
    SELECT CAST(c_custkey // 200 AS VARCHAR) AS org_id, CAST(count(*) AS INTEGER) AS member_count,
           CAST(sum(c_custkey) AS BIGINT) AS member_ids, min(c_name) AS first_member,
           CAST(count(DISTINCT c_custkey % 5) FILTER (c_custkey % 5 < 3) AS INTEGER) AS repo_count,
           string_agg(DISTINCT 'repo-' || CAST(c_custkey % 5 AS VARCHAR), ',' ORDER BY 'repo-' || CAST(c_custkey % 5 AS VARCHAR))
               FILTER (c_custkey % 5 < 3) AS repo_names
    FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1
    """
)
def paged_orgs(spark, sf_dir):
    """Members and repositories of an organization landed in several pages, some without one of the lists."""
    customer = table(spark, sf_dir, "customer").filter("c_custkey is not null")
    block, page = F.floor(F.col("c_custkey") / 200).cast("bigint"), F.col("c_custkey") % 5
    member = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("login"))
    pages = customer.groupBy(block.alias("block"), page.alias("page")).agg(F.collect_list(member).alias("members"))
    repo = F.struct((F.col("block") * 10 + F.col("page")).alias("id"), F.concat(F.lit("repo-"), F.col("page").cast("string")).alias("name"))
    landed_pages = pages.select(
        F.concat(F.lit("org-"), F.col("block").cast("string")).alias("org_name"),
        F.to_json(F.struct(F.col("block").alias("id"), F.lit(3).alias("public_repos"))).alias("org"),
        F.to_json("members").alias("members"),
        F.when(F.col("page") < 3, F.to_json(F.array(repo))).alias("repos"),
    )
    orgs = org_snapshot(whole_orgs(landed_pages), DAY)
    ids = F.aggregate("members", F.lit(0).cast("bigint"), lambda s, m: s + m["id"].cast("bigint"))
    return orgs.select(
        "org_id",
        "metrics.member_count",
        ids.alias("member_ids"),
        F.array_min(F.transform("members", lambda m: m["name"])).alias("first_member"),
        F.size("repos").alias("repo_count"),
        F.array_join(F.array_sort(F.transform("repos", lambda r: r["name"])), ",").alias("repo_names"),
    )
