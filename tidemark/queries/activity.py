"""Contributor activity and pull requests."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.functions.text import spaced
from tidemark.functions.times import time_text
from tidemark.operators.incremental import (
    high_water_marks,
    load,
    reject_reason,
    with_epoch,
)
from tidemark.operators.merge import ACTION, merge_actions, merge_metrics, merge_plan
from tidemark.operators.policies import CONTRIBUTORS, PULLS
from tidemark.plans.contributors import active_weeks, contributor_records, contributor_reject_reason, contributor_rollup
from tidemark.plans.pulls import (
    pull_details,
    pull_facts,
    pull_records,
    pull_reviews,
    pull_rows,
    review_rollup,
    with_details,
)
from tidemark.queries.registry import query, scratch_database, table
from tidemark.sources import catalog
from tidemark.sources.staging import stage, staged

AT = datetime(2024, 2, 1, 12, 0, 0)


def weekly_records(spark, sf_dir, repo, before: date | None = None):
    """Contributor records from events: one array element per week.

    Events are counted per week first, so an array is bounded by the weeks there are.
    """
    events = table(spark, sf_dir, "events")
    if before:
        events = events.filter(F.col("ts") < F.lit(before))
    count = lambda kind: F.count_if(F.col("event_type") == kind).cast("int")
    weeks = events.groupBy(
        "user_id", repo.alias("repo_id"), F.to_date(F.date_trunc("week", "ts")).alias("week")
    ).agg(count("click").alias("a"), count("error").alias("d"), count("purchase").alias("c"))
    week = F.struct((F.unix_date("week").cast("bigint") * 86400).alias("w"), "a", "d", "c")
    people = weeks.groupBy("user_id", "repo_id").agg(F.collect_list(week).alias("weeks"))
    author = F.struct(F.col("user_id").alias("id"), F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("login"))
    return people.select(
        F.lit("1").alias("org_id"),
        F.lit("org").alias("org_name"),
        "repo_id",
        F.concat(F.lit("repo-"), "repo_id").alias("repo_name"),
        F.struct(author.alias("author"), "weeks").alias("record"),
    )


# The week counts of the oracles below: a filter inside the aggregates keeps
# contributors without an active week.
WEEKS = """
    WITH counted AS (
        SELECT user_id, {repo} AS repo_id, CAST(date_trunc('week', ts) AS DATE) AS week,
               count(*) FILTER (WHERE event_type = 'click') AS a,
               count(*) FILTER (WHERE event_type = 'error') AS d,
               count(*) FILTER (WHERE event_type = 'purchase') AS c
        FROM events {where} GROUP BY 1, 2, 3
    )
    SELECT CAST(user_id AS VARCHAR) AS user_id, repo_id,
           min(week) FILTER (WHERE a + d + c > 0) AS first_week,
           max(week) FILTER (WHERE a + d + c > 0) AS last_week,
           CAST(count(*) FILTER (WHERE a + d + c > 0) AS INTEGER) AS weeks,
           CAST(sum(a) AS INTEGER) AS lines_added, CAST(sum(d) AS INTEGER) AS lines_deleted,
           CAST(sum(c) AS INTEGER) AS commits
    FROM counted GROUP BY 1, 2
"""


def flat_contributors(df):
    return df.select("user_id", "repo_id", "first_week", "last_week", "activity.*")


@query(WEEKS.format(repo="'1'", where=""), name="contributor_rollup")
def contributor_rollup_weeks(spark, sf_dir):
    """Weekly arrays folded to one row per contributor."""
    return flat_contributors(contributor_rollup(active_weeks(weekly_records(spark, sf_dir, F.lit("1")), AT)))


@query(
    f"""
    WITH t AS ({WEEKS.format(repo="CAST(event_id % 7 AS VARCHAR)", where="WHERE ts < TIMESTAMP '2024-01-22'")}),
    s AS ({WEEKS.format(repo="CAST(event_id % 7 AS VARCHAR)", where="")})
    SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.repo_id, t.repo_id) AS repo_id,
           CASE WHEN t.repo_id IS NULL OR t.last_week < s.last_week THEN s.first_week ELSE t.first_week END AS first_week,
           CASE WHEN t.repo_id IS NULL OR t.last_week < s.last_week THEN s.last_week ELSE t.last_week END AS last_week,
           CASE WHEN t.repo_id IS NULL OR t.last_week < s.last_week THEN s.commits ELSE t.commits END AS commits,
           CASE WHEN t.repo_id IS NULL THEN 'insert' WHEN t.last_week < s.last_week THEN 'update' ELSE 'keep' END AS action
    FROM s FULL OUTER JOIN t ON s.user_id = t.user_id AND s.repo_id = t.repo_id
    """
)
def contributor_merge(spark, sf_dir):
    """M3: only a later week replaces a contributor."""
    repo = (F.col("event_id") % 7).cast("string")
    old, new = (
        stage(contributor_rollup(active_weeks(weekly_records(spark, sf_dir, repo, before), AT)), "contributors")
        for before in (date(2024, 1, 22), None)
    )
    merged = merge_plan(old, new, CONTRIBUTORS)
    return merged.select(
        "user_id", "repo_id", "first_week", "last_week", "activity.commits", F.col(ACTION).alias("action")
    )


STATES = {"A": "APPROVED", "R": "CHANGES_REQUESTED", "N": "COMMENTED"}


@query(
    """
    WITH r AS (
        SELECT l_orderkey, count(*) AS review_count,
               count(*) FILTER (WHERE l_returnflag = 'A') AS approval_count,
               min(l_shipdate) AS first_submitted, max(l_shipdate) AS last_submitted
        FROM lineitem GROUP BY 1
    )
    SELECT CAST(o_orderkey AS VARCHAR) AS pull_id, lower(replace(o_orderpriority, '-', '_')) AS title,
           o_orderstatus = 'P' AS is_draft, o_orderdate AS created,
           review_count, approval_count, first_submitted, last_submitted
    FROM orders LEFT JOIN r ON l_orderkey = o_orderkey
    """
)
def pulls_flat(spark, sf_dir):
    """Pulls with the counts and times of their reviews."""
    state = F.element_at(F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair]), F.col("l_returnflag"))
    reviews = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", state.alias("state"))
    rollup = review_rollup(reviews, ("l_orderkey",), "l_shipdate", "state")
    orders = table(spark, sf_dir, "orders")
    return orders.join(rollup, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("pull_id"),
        F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit("_"))).alias("title"),
        (F.col("o_orderstatus") == "P").alias("is_draft"),
        F.col("o_orderdate").alias("created"),
        "review_count",
        "approval_count",
        "first_submitted",
        "last_submitted",
    )


def api_time(ts):
    return time_text(ts, api=True)


def landed_pulls(spark, sf_dir):
    """Pull pages, details and review lists as received, one order each.

    Every 17th pull has no author, every 19th a bad time, every 23rd an anonymous review.
    """
    orders = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    pull = F.struct(
        key.alias("id"),
        key.cast("int").alias("number"),
        F.col("o_orderpriority").alias("title"),
        F.when(key % 17 != 0, F.struct(F.col("o_custkey").alias("id"))).alias("user"),
        F.when(key % 3 == 0, F.array().cast("array<struct<name:string>>"))
        .otherwise(F.array(F.struct(F.col("o_orderstatus").alias("name"))))
        .alias("labels"),
        F.when(key % 4 != 0, F.col("o_orderstatus") == "P").alias("draft"),
        api_time(day).alias("created_at"),
        F.when(key % 19 == 0, F.lit("no time")).otherwise(api_time(F.date_add(day, 1))).alias("updated_at"),
        F.when(key % 2 == 0, api_time(F.date_add(day, 2))).alias("merged_at"),
    )
    ids = [
        F.lit("1").alias("org_id"),
        F.lit("org").alias("org_name"),
        (F.col("o_custkey") % 50).cast("string").alias("repo_id"),
        F.lit("repo").alias("repo_name"),
    ]
    number = key.cast("string").alias("pull_number")
    pages = orders.select(*ids, F.to_json(F.array(pull)).alias("page"))
    detail = F.struct(
        (key % 5).alias("comments"), (key % 6).alias("review_comments"), (key % 7).alias("commits"),
        (key % 8).alias("changed_files"),
    )
    details = orders.select(ids[2], number, F.to_json(detail).alias("detail"))
    review = lambda n, state: F.struct(
        (key * 10 + n).alias("id"),
        F.when(key % 23 != 0, F.struct((F.col("o_custkey") + n).alias("id"))).alias("user"),
        F.lit(state).alias("state"),
        api_time(F.date_add(day, n)).alias("submitted_at"),
    )
    lists = F.when(key % 5 == 0, F.array(review(1, "CHANGES_REQUESTED"), review(2, "APPROVED"))).when(
        key % 5 == 1, F.array(review(1, "COMMENTED"))
    )
    reviews = orders.filter(key % 5 < 3).select(
        ids[2], number, F.coalesce(F.to_json(lists), F.lit("[]")).alias("reviews")
    )
    return pages, details, reviews


def detailed_pulls(spark, sf_dir):
    pages, details, reviews = landed_pulls(spark, sf_dir)
    rows = pull_rows(pull_records(pages), AT)
    return with_details(rows, pull_details(details), pull_reviews(reviews))


BAD = """CASE WHEN o_orderkey % 17 = 0 OR o_custkey IS NULL THEN 'missing author'
              WHEN o_orderkey % 19 = 0 THEN 'malformed updated time'
              WHEN o_orderkey % 23 = 0 AND o_orderkey % 5 < 2 THEN 'missing reviewer' END"""


@query(
    f"""
    WITH v AS (
        SELECT o_orderkey AS k, 1 AS n, CASE WHEN o_orderkey % 5 = 0 THEN 'changes requested' ELSE 'commented' END AS action
        FROM orders WHERE o_orderkey % 5 < 2
        UNION ALL SELECT o_orderkey, 2, 'approved' FROM orders WHERE o_orderkey % 5 = 0
    )
    SELECT CAST(o_orderkey AS VARCHAR) AS pull_id, CAST(o_custkey % 50 AS VARCHAR) AS repo_id,
           CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS title,
           CASE WHEN o_orderkey % 3 <> 0 THEN coalesce(o_orderstatus, '') END AS labels,
           coalesce(o_orderkey % 4 <> 0 AND o_orderstatus = 'P', false) AS is_draft,
           o_orderdate AS created, o_orderdate + INTERVAL 1 DAY AS updated,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 2 DAY END AS merged,
           CAST(o_orderkey % 5 AS INTEGER) AS comment_count, CAST(o_orderkey % 8 AS INTEGER) AS changed_file_count,
           CAST(o_orderkey * 10 + n AS VARCHAR) AS review_id, action,
           CAST(o_custkey + n AS VARCHAR) AS reviewer_id, o_orderdate + n * INTERVAL 1 DAY AS submitted
    FROM orders LEFT JOIN v ON k = o_orderkey
    WHERE {BAD} IS NULL
    """
)
def pulls_nested(spark, sf_dir):
    """Typed pulls from nested texts, one row per review."""
    facts, _ = pull_facts(detailed_pulls(spark, sf_dir))
    flat = facts.select("*", F.explode_outer("reviews").alias("review"))
    return flat.select(
        "pull_id",
        "repo_id",
        "user_id",
        "title",
        F.array_join("labels", ",").alias("labels"),
        "is_draft",
        "time.created",
        "time.updated",
        "time.merged",
        "metrics.comment_count",
        "metrics.changed_file_count",
        "review.review_id",
        "review.action",
        F.col("review.user_id").alias("reviewer_id"),
        "review.submitted",
    )


@query(f"SELECT * FROM (SELECT CAST(o_orderkey AS VARCHAR) AS pull_id, {BAD} AS reject_reason FROM orders) WHERE reject_reason IS NOT NULL")
def pull_rejects(spark, sf_dir):
    """pulls set aside, with the reason."""
    _, rejects = pull_facts(detailed_pulls(spark, sf_dir))
    return rejects.select("pull_id", "reject_reason")


def pull_versions(spark, sf_dir):
    """Stored pulls and a batch of newer ones that overlaps them."""
    key = F.col("o_orderkey")
    row = lambda updated: [
        (F.col("o_custkey") % 50).cast("string").alias("repo_id"),
        key.cast("string").alias("pull_id"),
        F.struct(F.col("o_orderdate").alias("created"), updated.alias("updated")).alias("time"),
    ]
    orders = table(spark, sf_dir, "orders")
    later = F.when(key % 20 == 7, F.col("o_orderdate") + F.expr("interval 1 day")).otherwise(F.col("o_orderdate"))
    target = orders.filter(key % 10 < 8).select(*row(F.col("o_orderdate")))
    source = orders.filter(key % 10 >= 7).select(*row(later))
    return target, source


PULL_VERSIONS = """
    WITH t AS (SELECT o_custkey % 50 AS repo, o_orderkey, o_orderdate AS updated FROM orders WHERE o_orderkey % 10 < 8),
    s AS (SELECT o_custkey % 50 AS repo, o_orderkey,
                 o_orderdate + CASE WHEN o_orderkey % 20 = 7 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS updated
          FROM orders WHERE o_orderkey % 10 >= 7),
    merged AS (
        SELECT CAST(coalesce(t.repo, s.repo) AS VARCHAR) AS repo_id,
               CAST(coalesce(t.o_orderkey, s.o_orderkey) AS VARCHAR) AS pull_id,
               CASE WHEN t.o_orderkey IS NULL OR s.updated > t.updated THEN s.updated ELSE t.updated END AS updated,
               CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.updated > t.updated THEN 'update' ELSE 'keep' END AS action
        FROM t FULL OUTER JOIN s ON t.repo = s.repo AND t.o_orderkey = s.o_orderkey
    )
"""


@query(PULL_VERSIONS + "SELECT * FROM merged")
def pulls_merge(spark, sf_dir):
    """The newest version of a pull wins."""
    merged = merge_plan(*pull_versions(spark, sf_dir), PULLS)
    return merged.select("repo_id", "pull_id", "time.updated", F.col(ACTION).alias("action"))


@query(
    PULL_VERSIONS
    + """SELECT count(*) FILTER (WHERE action <> 'keep') AS num_affected_rows,
                count(*) FILTER (WHERE action = 'update') AS num_updated_rows,
                CAST(0 AS BIGINT) AS num_deleted_rows,
                count(*) FILTER (WHERE action = 'insert') AS num_inserted_rows
         FROM merged""",
    name="merge_metrics",
)
def merge_counts(spark, sf_dir):
    """M7: what a merge does, counted without building its rows."""
    return merge_metrics(merge_actions(*pull_versions(spark, sf_dir), PULLS))


@query(
    """
    WITH t AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS VARCHAR) END AS repo_id,
                      CAST(o_orderkey AS VARCHAR) AS pull_id, o_orderdate AS updated FROM orders WHERE o_orderkey % 10 < 8),
    s AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS VARCHAR) END AS repo_id,
                 CAST(o_orderkey AS VARCHAR) AS pull_id, o_orderdate + INTERVAL 1 DAY AS updated
          FROM orders WHERE o_orderkey % 10 >= 7)
    SELECT coalesce(t.repo_id, s.repo_id) AS repo_id, coalesce(t.pull_id, s.pull_id) AS pull_id,
           CASE WHEN t.pull_id IS NULL OR s.updated > t.updated THEN s.updated ELSE t.updated END AS updated,
           CASE WHEN t.pull_id IS NULL THEN 'insert' WHEN s.updated > t.updated THEN 'update' ELSE 'keep' END AS action
    FROM t FULL OUTER JOIN s ON t.repo_id = s.repo_id AND t.pull_id = s.pull_id
    """
)
def merge_null_keys(spark, sf_dir):
    """Merge rule: a NULL key, here held by a third of the rows, never matches."""
    key = F.col("o_orderkey")
    repo = F.when(key % 3 != 0, (F.col("o_custkey") % 50).cast("string")).alias("repo_id")
    orders = table(spark, sf_dir, "orders")

    def side(df, days):
        updated = F.col("o_orderdate") + F.expr(f"interval {days} day")
        return df.select(repo, key.cast("string").alias("pull_id"), F.struct(updated.alias("updated")).alias("time"))

    merged = merge_plan(side(orders.filter(key % 10 < 8), 0), side(orders.filter(key % 10 >= 7), 1), PULLS)
    return merged.select("repo_id", "pull_id", "time.updated", F.col(ACTION).alias("action"))


@query(
    """
    SELECT r_name AS org_name, n_name AS repo_name, coalesce(max(o_orderdate), TIMESTAMP '1970-01-01') AS mark
    FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (customer JOIN orders ON o_custkey = c_custkey)
        ON c_nationkey = n_nationkey AND n_nationkey % 6 <> 0
    GROUP BY 1, 2
    """
)
def high_water_mark(spark, sf_dir):
    """A4: latest update of every repository, the epoch where there is none.

    Orders are reduced to one date per customer before they meet the customers.
    """
    repos = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("org_name"), F.col("n_name").alias("repo_name"))
    )
    by_customer = high_water_marks(table(spark, sf_dir, "orders"), ("o_custkey",), "o_orderdate")
    customers = table(spark, sf_dir, "customer").filter("c_nationkey % 6 <> 0").select("c_custkey", "c_nationkey")
    by_nation = high_water_marks(
        by_customer.join(customers, F.col("o_custkey") == F.col("c_custkey")), ("c_nationkey",), "mark"
    )
    stored = by_nation.join(repos, F.col("c_nationkey") == F.col("n_nationkey")).select("org_name", "repo_name", "mark")
    return with_epoch(repos, stored, ("org_name", "repo_name"))


@query(
    """
    WITH marks AS (SELECT o_custkey, max(o_orderdate) AS mark FROM orders WHERE o_orderkey % 10 < 6 GROUP BY 1)
    SELECT o_orderkey, orders.o_custkey, o_orderdate FROM orders LEFT JOIN marks ON orders.o_custkey = marks.o_custkey
    WHERE o_orderdate IS NULL OR CAST(o_orderdate AS DATE) >= CAST(coalesce(mark, TIMESTAMP '1970-01-01') AS DATE)
    """
)
def incremental_filter(spark, sf_dir):
    """records updated on or after the day of their group's mark."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    marks = high_water_marks(orders.filter("o_orderkey % 10 < 6"), ("o_custkey",), "o_orderdate")
    records = orders.withColumn("updated_at", api_time(F.col("o_orderdate")))
    fresh = load(records, "new", marks=marks, groups=("o_custkey",), updated=F.col("updated_at"))
    return fresh.select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':0'), o_orderkey LIMIT 3
    """,
    name="sample_rows",
)
def sample_pulls(spark, sf_dir):
    """three records picked by a hash of their key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return load(orders, "sample", key="o_orderkey")


@query(
    """
    SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':0'), o_orderkey) <= 3
    """
)
def sample_per_group(spark, sf_dir):
    """three records of every group, picked by a hash of their key."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return load(orders, "sample", key="o_orderkey", groups=("o_custkey",))


def paged_pulls(spark, sf_dir):
    """Orders as pulls, lines as their reviews in pages of two line numbers; ids, details and pages partly corrupt."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    ids = [F.lit("1").alias("org_id"), F.lit("org").alias("org_name"), F.lit("5").alias("repo_id"), F.lit("repo").alias("repo_name")]
    body = F.struct(
        F.when(key % 29 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string")).alias("id"),
        key.alias("number"), F.struct(F.coalesce("o_custkey", F.lit(0)).alias("id")).alias("user"), api_time(day).alias("updated_at"),
    )
    pages = orders.select(*ids, F.to_json(F.array(body)).alias("page"))
    number = key.cast("string").alias("pull_number")
    detail = F.when(key % 31 == 0, "not json").when(key % 37 == 0, '{"commits": "many"}').when(key % 41 == 0, '{"commits": 3000000000}').otherwise('{"commits": "12"}')
    details = orders.select(ids[2], number, detail.alias("detail"))
    review = F.struct(F.col("l_linenumber").alias("id"), F.struct(F.col("l_suppkey").alias("id")).alias("user"),
                      F.lit("APPROVED").alias("state"), api_time(F.col("l_shipdate")).alias("submitted_at"))
    review_pages = lines.groupBy(F.col("l_orderkey").alias("k"), F.floor(F.col("l_linenumber") / 2).alias("at")).agg(F.collect_list(review).alias("page"))
    reviews = review_pages.select(ids[2], F.col("k").cast("string").alias("pull_number"), F.to_json("page").alias("reviews"))
    return with_details(pull_rows(pull_records(pages), AT), pull_details(details), pull_reviews(reviews))


UNREADABLE = """CASE WHEN o_orderkey % 29 = 0 THEN 'missing id'
                     WHEN o_orderkey % 31 = 0 OR o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 THEN 'unreadable details' END"""


@query(
    f"""
    WITH r AS (SELECT l_orderkey, count(*) AS reviews, min(l_suppkey) AS first_reviewer FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS pull_number, CAST(12 AS INTEGER) AS commit_count, coalesce(reviews, 0) AS reviews, first_reviewer
    FROM orders LEFT JOIN r ON l_orderkey = o_orderkey WHERE {UNREADABLE} IS NULL
    """
)
def pull_review_pages(spark, sf_dir):
    """Reviews landed in several pages a pull, concatenated before the join."""
    facts, _ = pull_facts(paged_pulls(spark, sf_dir))
    first = F.array_min(F.transform("reviews", lambda r: r["user_id"].cast("bigint")))
    return facts.select(
        "pull_number", "metrics.commit_count", F.coalesce(F.array_size("reviews"), F.lit(0)).cast("bigint").alias("reviews"), first.alias("first_reviewer")
    )


@query(f"SELECT * FROM (SELECT CAST(o_orderkey AS VARCHAR) AS pull_number, {UNREADABLE} AS reject_reason FROM orders) WHERE reject_reason IS NOT NULL")
def unreadable_pulls(spark, sf_dir):
    """pulls whose id or details do not parse are set aside with the reason."""
    _, rejects = pull_facts(paged_pulls(spark, sf_dir))
    return rejects.select("pull_number", "reject_reason")


@query(
    f"""
    WITH n AS (SELECT count(*) AS good FROM orders WHERE {UNREADABLE} IS NULL)
    SELECT 1 AS run, good AS num_inserted_rows, CAST(0 AS BIGINT) AS num_updated_rows FROM n
    UNION ALL SELECT 2, CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    """
)
def unreadable_pulls_again(spark, sf_dir):
    """A merge of a landing with corrupt records, repeated, changes nothing."""
    name = f"{scratch_database(spark)}.pulls"
    with staged(pull_facts(paged_pulls(spark, sf_dir))[0], "pulls") as facts:
        runs = [catalog.merge_into(facts, name, PULLS, frozen=True).first() for _ in range(2)]
    rows = [(n + 1, r["num_inserted_rows"], r["num_updated_rows"]) for n, r in enumerate(runs)]
    return spark.createDataFrame(rows, "run int, num_inserted_rows bigint, num_updated_rows bigint")


@query(
    """
    WITH p AS (SELECT DISTINCT user_id FROM events)
    SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN user_id % 7 = 0 THEN 'unreadable week' END AS reject_reason FROM p
    """
)
def unreadable_weeks(spark, sf_dir):
    """a contributor with a week whose count does not parse is set aside, not cut short."""
    people = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    week = F.struct(F.lit(1704067200).alias("w"), F.when(F.col("user_id") % 7 == 0, "many").otherwise(F.col("n").cast("string")).alias("a"), F.lit(0).alias("d"), F.lit(1).alias("c"))
    record = F.struct(F.struct(F.col("user_id").alias("id"), F.lit("someone").alias("login")).alias("author"), F.array(week).alias("weeks"))
    ids = [F.lit("1").alias("org_id"), F.lit("org").alias("org_name"), F.lit("5").alias("repo_id"), F.lit("repo").alias("repo_name")]
    records = contributor_records(people.select(*ids, F.to_json(F.array(record)).alias("page")), AT)
    return records.select("user_id", contributor_reject_reason().alias("reject_reason"))


@query(
    """
    SELECT event_id, CASE WHEN event_id % 17 = 0 OR user_id IS NULL THEN 'missing user'
                          WHEN event_id % 13 = 0 THEN 'malformed submitted' END AS reason,
           CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) END AS submitted
    FROM events
    """
)
def rejects_split(spark, sf_dir):
    """Each record's reason for being set aside, if any."""
    text = F.when(F.col("event_id") % 13 == 0, F.lit("2024-99-01T00:00:00Z")).otherwise(api_time(F.col("ts")))
    user = F.when(F.col("event_id") % 17 != 0, F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("submitted_at"), user.alias("user_id"))
    reason = reject_reason({"user": F.col("user_id")}, {"submitted": F.col("submitted_at")})
    return events.select("event_id", reason.alias("reason"), F.col("submitted_at").try_cast("timestamp_ntz").alias("submitted"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lower(replace('CHANGES_' || l_returnflag, '_', ' ')) AS action
    FROM lineitem
    """
)
def review_actions(spark, sf_dir):
    """Review states in readable form."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        spaced(F.concat(F.lit("CHANGES_"), "l_returnflag")).alias("action"),
    )
