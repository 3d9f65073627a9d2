"""Profiles, dates, table lifecycle, layout and whole runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators.layout import cluster_table, file_layout
from tidemark.operators.merge import MergeSpec
from tidemark.operators.policies import ORG_SNAPSHOT, PULLS, PULLS_IN_BLOCKS, USERS
from tidemark.operators import profile as profiles
from tidemark.operators.profile import column_profile, freshness
from tidemark.operators.profile import table_profile as table_profile_row
from tidemark.operators.select import select_ordered, select_prefix
from tidemark.plans import pulls
from tidemark.plans.derived import DerivedTable, GroupedTable
from tidemark.plans.pulls import in_blocks
from tidemark.plans.workflow import PULL_REJECTS, Landing, run_all
from tidemark.queries.activity import api_time
from tidemark.queries.catalogue import schema_docs
from tidemark.queries.registry import query, scratch_database, spread_table, table
from tidemark.session import scratch_path
from tidemark.sources import catalog, marks, quarantine
from tidemark.sources.staging import sql_over, stage
from tidemark.streaming.intake import merge_stream


@query(
    """
    SELECT count(*) AS row_count,
           CAST(min(o_orderkey) AS VARCHAR) AS min_o_orderkey, CAST(max(o_orderkey) AS VARCHAR) AS max_o_orderkey,
           strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS min_o_orderdate,
           strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS max_o_orderdate,
           min(o_orderpriority) AS min_o_orderpriority, max(o_orderpriority) AS max_o_orderpriority,
           count(DISTINCT o_custkey) AS distinct_o_custkey
    FROM orders
    """
)
def table_profile(spark, sf_dir):
    """Counts and extremes in one pass, dates as text."""
    orders = table(spark, sf_dir, "orders")
    return column_profile(orders, ["o_orderkey", "o_orderdate", "o_orderpriority"], distinct=["o_custkey"])


@query("SELECT strftime(max(CAST(l_shipdate AS DATE)), '%Y-%m-%d') AS last_update FROM lineitem", name="freshness")
def table_freshness(spark, sf_dir):
    """The latest snapshot date as text."""
    return freshness(table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("dt")))


@query(
    """
    SELECT 'columns' AS fact, 'o_orderkey,o_orderdate,o_custkey' AS value
    UNION ALL SELECT 'types', 'bigint,timestamp_ntz,bigint'
    UNION ALL SELECT 'schema', 'o_orderkey,o_orderdate,o_custkey'
    UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM orders
    UNION ALL SELECT 'distinct', CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM orders
    UNION ALL SELECT 'latest', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') FROM orders
    UNION ALL SELECT 'ddl', 'true'
    UNION ALL SELECT 'profile', 'true ' || CAST(count(*) AS VARCHAR) FROM orders
    UNION ALL SELECT 'like', '0'
    UNION ALL SELECT 'prefix', 'o_orderkey,o_orderdate'
    UNION ALL SELECT 'dropped', 'true,false'
    """
)
def table_facts(spark, sf_dir):
    """What the catalog tells about a created table, until it is dropped."""
    name = f"{scratch_database(spark)}.orders"
    orders = catalog.create_as(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey"), name)
    profile = table_profile_row(spark, name).first()
    like = catalog.ensure_like(orders, f"{name}_like")
    facts = [
        ("columns", ",".join(profiles.columns(spark, name))),
        ("types", ",".join(profiles.column_types(spark, name).values())),
        ("schema", ",".join(profiles.schema(spark, name).names)),
        ("rows", str(profiles.row_count(spark, name))),
        ("distinct", str(profiles.distinct_count(spark, name, "o_custkey"))),
        ("latest", profiles.extreme(spark, name, "o_orderdate", "max")),
        ("ddl", str(catalog.ddl_text(spark, name).startswith("CREATE TABLE")).lower()),
        ("profile", f"{str(profile['exists']).lower()} {profile['row_count']}"),
        ("like", str(like.count())),
        ("prefix", ",".join(select_prefix(orders, "o_order").columns)),
    ]
    dropped = catalog.drop_all(spark, [name, f"{name}_absent"]).orderBy("table_name").collect()
    facts.append(("dropped", ",".join(str(r["dropped"]).lower() for r in dropped)))
    return spark.createDataFrame(facts, "fact string, value string")


SPANS = "WITH spans AS (SELECT user_id, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1)"


def event_spans(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(
    SPANS
    + """ SELECT user_id, CAST(unnest(generate_series(date_trunc('day', first), date_trunc('day', last), INTERVAL 1 DAY)) AS DATE)
          AS day FROM spans"""
)
def day_range(spark, sf_dir):
    """All days of each user's span, both ends included."""
    return event_spans(spark, sf_dir).select(
        "user_id", F.explode(times.day_span(F.col("first"), F.col("last"))).alias("day")
    )


@query(
    SPANS
    + """, days AS (SELECT user_id, date_trunc('day', last) AS final,
                  unnest(generate_series(date_trunc('day', first), date_trunc('day', last), INTERVAL 1 DAY)) AS day FROM spans),
         sizes AS (SELECT user_id, count(*) AS n FROM days GROUP BY 1)
         SELECT days.user_id, day AS moment FROM days JOIN sizes ON days.user_id IS NOT DISTINCT FROM sizes.user_id
         WHERE day < final OR n = 1
         UNION ALL SELECT DISTINCT user_id, final + INTERVAL '86399' SECOND FROM days"""
)
def day_range_times(spark, sf_dir):
    """The same as timestamps, the last one a second before midnight."""
    return event_spans(spark, sf_dir).select(
        "user_id", F.explode(times.day_span_times(F.col("first"), F.col("last"))).alias("moment")
    )


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS plain,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS api,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS from_plain,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS from_custom,
           strftime(o_orderdate, '%Y-%m-%d') AS unix_day, '2024-02-01T12:00:00Z' AS run_time, '2024-02-01' AS run_day
    FROM orders
    """
)
def time_formats(spark, sf_dir):
    """Text forms of a timestamp, and of the run's clock."""
    at = datetime(2024, 2, 1, 12, 0, 0)
    day = F.col("o_orderdate")
    seconds = F.unix_date(F.to_date(day)).cast("bigint") * 86400 + 3600
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.time_text(day).alias("plain"),
        times.time_text(day, api=True).alias("api"),
        times.reformat_to_api(times.time_text(day)).alias("from_plain"),
        times.reformat_to_api(F.date_format(day, "dd/MM/yyyy HH.mm"), "dd/MM/yyyy HH.mm").alias("from_custom"),
        times.unix_day_text(seconds).alias("unix_day"),
        times.run_time(at).alias("run_time"),
        times.run_day(at).alias("run_day"),
    )


@query("SELECT o_orderdate, o_orderkey, o_orderstatus FROM orders", name="select_ordered")
def select_columns(spark, sf_dir):
    """Columns in the order asked for."""
    return select_ordered(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey", "o_orderstatus"])[0]


@query(
    """
    SELECT o_orderpriority, count(*) AS orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1
    """
)
def sql_over_frames(spark, sf_dir):
    """SQL over a DataFrame without a global view name."""
    return sql_over(
        spark,
        "select o_orderpriority, count(*) as orders, max(o_orderdate) as last_order from {o} group by o_orderpriority",
        o=table(spark, sf_dir, "orders"),
    )


@query(
    """
    SELECT l_suppkey, l_returnflag, count(*) AS lines, sum(l_quantity) AS quantity,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(DISTINCT l_orderkey) AS orders
    FROM lineitem GROUP BY 1, 2
    """
)
def clustered_write(spark, sf_dir):
    """The contents of a table rewritten clustered are what they were before."""
    name = f"{scratch_database(spark)}.lines"
    catalog.create_as(table(spark, sf_dir, "lineitem"), name)
    cluster_table(spark, name, ["l_shipdate", "l_partkey", "l_returnflag"])
    return catalog.read(spark, name).groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.count_distinct("l_orderkey").alias("orders"),
    )


@query(
    """
    SELECT count(*) AS rows, count(DISTINCT o_orderpriority) AS priorities, true AS narrower
    FROM orders WHERE o_orderkey IS NOT NULL
    """
)
def clustered_ranges(spark, sf_dir):
    """After clustering by prefixed text, a file's range of values is a part of the whole."""
    name = F.format_string("repository-%012d", "o_orderkey").alias("name")
    orders = table(spark, sf_dir, "orders").filter("o_orderkey is not null").select(name, "o_orderpriority")
    table_name = f"{scratch_database(spark)}.names"
    catalog.create_as(orders, table_name)
    cluster_table(spark, table_name, ["name"], target_bytes=1 << 16)
    written = catalog.read(spark, table_name)
    ranges = file_layout(written, ["name"])
    whole = written.agg(F.count("*").alias("rows"), F.count_distinct("o_orderpriority").alias("priorities"))
    # Ranges of files must not overlap but at their ends: a sum of widths below twice the whole.
    width = F.substring("max_name", 12, 12).cast("bigint") - F.substring("min_name", 12, 12).cast("bigint")
    low, high = F.min(F.substring("min_name", 12, 12).cast("bigint")), F.max(F.substring("max_name", 12, 12).cast("bigint"))
    overlap = ranges.agg(F.coalesce(F.sum(width) < 2 * (high - low) + 1, F.lit(True)).alias("narrower"))
    return whole.withColumn("narrower", F.lit(overlap.first()[0]))


@query(
    """
    SELECT o_orderkey, o_orderstatus, 'created' AS origin FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, 'appended' FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, o_orderstatus, 'published' FROM orders WHERE o_orderstatus = 'O'
    """
)
def publish_roundtrip(spark, sf_dir):
    """Create, append, publish over itself, copy, read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    part = lambda status, origin: orders.filter(F.col("o_orderstatus") == status).withColumn("origin", F.lit(origin))
    name = f"{scratch_database(spark)}.orders"
    catalog.create(spark, name, "o_orderkey bigint, o_orderstatus string, origin string")
    catalog.overwrite(part("F", "created"), name)
    catalog.append(part("P", "appended").select("origin", "o_orderstatus", "o_orderkey"), name)
    catalog.publish(catalog.read(spark, name).unionByName(part("O", "published")), name)
    catalog.create_as(spark.table(name), f"{name}_copy")
    return catalog.read(spark, f"{name}_copy")


@query(
    """
    WITH t AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id, count(*) AS n FROM orders WHERE o_orderkey % 4 < 3 GROUP BY 1),
    s AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id, count(*) AS n FROM orders GROUP BY 1)
    SELECT user_id, CAST(n AS VARCHAR) || ' orders' AS user_name FROM s
    UNION ALL SELECT user_id, CAST(n AS VARCHAR) || ' orders' FROM t WHERE user_id IS NULL  -- a NULL key never matches
    """
)
def derived_refresh(spark, sf_dir):
    """A derived table created from its query, then refreshed."""
    orders = table(spark, sf_dir, "orders")
    title = F.concat(F.count("*").cast("string"), F.lit(" orders")).alias("user_name")

    def build(keep):
        return lambda _: orders.filter(keep).groupBy(F.col("o_custkey").cast("string").alias("user_id")).agg(title)

    name = f"{scratch_database(spark)}.users"
    spec = MergeSpec(keys=("user_id",), update_when=lambda t, s: t("user_name") != s("user_name"))
    DerivedTable(name, build("o_orderkey % 4 < 3"), spec).refresh(spark)
    DerivedTable(name, build("true"), spec).refresh(spark)
    return spark.table(name)


@query(
    """
    SELECT CAST(o_custkey % 20 AS VARCHAR) AS repo_id, CAST(o_orderkey AS VARCHAR) AS pull_id,
           o_orderdate + CASE WHEN o_orderkey % 6 = 0 AND o_custkey IS NOT NULL THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
               AS updated
    FROM orders
    UNION ALL  -- a NULL key never matches, so the newer version is another row
    SELECT NULL, CAST(o_orderkey AS VARCHAR), o_orderdate + INTERVAL 1 DAY FROM orders
    WHERE o_orderkey % 6 = 0 AND o_custkey IS NULL
    """
)
def merge_into_partitions(spark, sf_dir):
    """M4, M8: merges into a partitioned catalog table, touched partitions only."""
    orders = table(spark, sf_dir, "orders")

    def rows(df, days):
        updated = F.col("o_orderdate") + F.expr(f"interval {days} day")
        return df.select(
            (F.col("o_custkey") % 20).cast("string").alias("repo_id"),
            F.col("o_orderkey").cast("string").alias("pull_id"),
            F.struct(updated.alias("updated")).alias("time"),
        )

    name = f"{scratch_database(spark)}.pulls"
    catalog.merge_into(rows(orders.filter("o_orderkey % 3 < 2"), 0), name, PULLS)
    catalog.merge_into(rows(orders.filter("o_orderkey % 3 = 2"), 0), name, PULLS)
    catalog.merge_into(rows(orders.filter("o_orderkey % 6 = 0"), 1), name, PULLS)
    return catalog.read(spark, name).select("repo_id", "pull_id", "time.updated")


@query(
    """
    SELECT CASE WHEN o_custkey % 3 < 2 THEN 'hot' ELSE 'other' END AS repo_id, CAST(o_orderkey AS VARCHAR) AS pull_id,
           o_orderkey // 5000 AS pull_block,
           o_orderdate + CASE WHEN o_orderkey // 5000 % 3 = 0 AND o_orderkey % 50 < 2 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS updated
    FROM orders
    """
)
def merge_into_blocks(spark, sf_dir):
    """M4: a hot repository split into blocks of ids, few of them rewritten."""
    repo = F.when(F.col("o_custkey") % 3 < 2, "hot").otherwise("other").alias("repo_id")

    def rows(df, days):
        updated = F.col("o_orderdate") + F.expr(f"interval {days} day")
        key = F.col("o_orderkey").cast("string").alias("pull_id")
        return in_blocks(df.select(repo, key, F.struct(updated.alias("updated")).alias("time")), 5000)

    orders = table(spark, sf_dir, "orders")
    name = f"{scratch_database(spark)}.pulls"
    catalog.merge_into(rows(orders, 0), name, PULLS_IN_BLOCKS)
    catalog.merge_into(rows(orders.filter("o_orderkey div 5000 % 3 = 0 and o_orderkey % 50 < 2"), 1), name, PULLS_IN_BLOCKS)
    return catalog.read(spark, name).select("repo_id", "pull_id", "pull_block", "time.updated")


@query(
    """
    SELECT CAST(o_custkey % 20 AS VARCHAR) AS repo_id, CAST(o_orderkey AS VARCHAR) AS pull_id,
           o_orderdate + CASE WHEN o_orderkey % 5 = 0 AND o_custkey IS NOT NULL THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
               AS updated
    FROM orders
    UNION ALL  -- a NULL key never matches, so the newer version is another row
    SELECT NULL, CAST(o_orderkey AS VARCHAR), o_orderdate + INTERVAL 1 DAY FROM orders
    WHERE o_orderkey % 5 = 0 AND o_custkey IS NULL
    """
)
def stream_intake(spark, sf_dir):
    """Landed files taken in as a stream, newer versions in a second landing."""
    orders = table(spark, sf_dir, "orders")
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    name = f"{scratch_database(spark)}.pulls"

    def land(df, days):
        repo = (F.col("o_custkey") % 20).cast("string").alias("repo")
        updated = api_time(F.col("o_orderdate") + F.expr(f"interval {days} day")).alias("updated_at")
        df.select(repo, "o_orderkey", updated).write.mode("append").json(landing)

    def transform(df):
        return df.select(
            F.col("repo").alias("repo_id"),
            F.col("o_orderkey").cast("string").alias("pull_id"),
            F.struct(times.to_time(F.col("updated_at")).alias("updated")).alias("time"),
        )

    def take_in():
        ddl = "repo string, o_orderkey bigint, updated_at string"
        merge_stream(spark, landing, ddl, transform, name, PULLS, "time.updated", checkpoint)

    land(orders, 0)
    take_in()
    land(orders.filter("o_orderkey % 5 = 0"), 1)
    take_in()
    return catalog.read(spark, name).select("repo_id", "pull_id", "time.updated")


def landing_of(spark, sf_dir, keep: str = "true", late: str = "false", authors: str = "o_orderkey % 9 <> 0") -> Landing:
    """Landed texts of a whole run: regions are organizations, nations repositories,
    orders pulls, events contributors' weeks, parts expectations.

    Only orders that ``keep`` holds for are landed; those ``late`` holds for were updated a
    day after they were created; ``authors`` tells which name one.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    member = F.struct((F.col("n_nationkey") + 1000).cast("bigint").alias("id"), F.concat(F.lit("owner-"), "n_name").alias("login"))
    repo = F.struct(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    orgs = (
        named.groupBy("r_regionkey", "r_name")
        .agg(F.collect_set(member).alias("members"), F.collect_set(repo).alias("repos"))
        .select(
            F.col("r_name").alias("org_name"),
            F.to_json(F.struct(F.col("r_regionkey").alias("id"), F.size("repos").alias("public_repos"))).alias("org"),
            F.to_json("members").alias("members"),
            F.to_json("repos").alias("repos"),
        )
    )
    ids = [F.col("r_name").alias("org_name"), F.col("n_name").alias("repo_name")]
    body = F.struct(F.col("n_nationkey").alias("id"), F.length("n_name").alias("forks_count"))
    repos = named.select(*ids, F.to_json(body).alias("repo"))

    weeks = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.unix_date(F.to_date(F.date_trunc("week", "ts"))).alias("week"))
        .agg(F.count("*").cast("int").alias("n"))
    )
    week = F.struct((F.col("week").cast("bigint") * 86400).alias("w"), F.col("n").alias("a"), F.lit(0).alias("d"), F.lit(1).alias("c"))
    people = weeks.groupBy("user_id").agg(F.collect_list(week).alias("weeks"))
    record = F.struct(F.struct(F.col("user_id").alias("id"), F.lit("someone").alias("login")).alias("author"), "weeks")
    contributors = people.join(named, F.col("user_id") % 25 == F.col("n_nationkey")).select(
        *ids, F.to_json(F.array(record)).alias("page")
    )

    customer = table(spark, sf_dir, "customer")
    orders = (
        spread_table(spark, sf_dir, "orders")
        .filter(keep)
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(named, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    pull = F.struct(
        key.alias("id"), key.cast("int").alias("number"), F.col("o_orderpriority").alias("title"),
        F.when(F.expr(authors), F.struct("o_custkey").cast("struct<id:bigint>")).alias("user"),
        F.array(F.struct(F.col("o_orderstatus").alias("name"))).alias("labels"),
        api_time(day).alias("created_at"),
        api_time(F.when(F.expr(late), day + F.expr("interval 1 day")).otherwise(day)).alias("updated_at"),
    )
    number = key.cast("string").alias("pull_number")
    pull_pages = orders.select(*ids, F.to_json(F.array(pull)).alias("page"))
    details = orders.select(*ids, number, F.to_json(F.struct((key % 5).alias("comments"))).alias("detail"))
    review = F.struct(key.alias("id"), F.struct(F.col("o_custkey").alias("id")).alias("user"),
                      F.lit("APPROVED").alias("state"), api_time(day).alias("submitted_at"))
    reviews = orders.filter(key % 2 == 0).select(*ids, number, F.to_json(F.array(review)).alias("reviews"))
    return Landing(orgs, repos, contributors, pull_pages, details, reviews, schema_docs(spark, sf_dir).select("value"))


@query(
    """
    WITH counts AS (
        SELECT 'source_orgs' AS table_name, (SELECT count(*) FROM region) AS n, NULL AS r
        UNION ALL SELECT 'source_repos', (SELECT count(*) FROM nation), NULL
        UNION ALL SELECT 'source_contributors', (SELECT count(DISTINCT user_id) FROM events), 0
        UNION ALL SELECT 'source_pulls', (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 <> 0),
                         (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 = 0)
        UNION ALL SELECT 'expectations', (SELECT count(*) FROM part), NULL
        UNION ALL SELECT 'users', 0, NULL
    )
    SELECT table_name, n AS num_affected_rows, CAST(0 AS BIGINT) AS num_updated_rows, CAST(0 AS BIGINT) AS num_deleted_rows,
           n AS num_inserted_rows, CAST(r AS BIGINT) AS num_rejected_rows
    FROM counts
    """
)
def run_everything(spark, sf_dir):
    """One run over all organizations and repositories; the counts of each merge."""
    names = lambda t, c: [r[0] for r in table(spark, sf_dir, t).select(c).collect()]
    return run_all(
        spark,
        scratch_database(spark),
        landing_of(spark, sf_dir),
        names("region", "r_name"),
        names("nation", "n_name"),
        at=datetime(2024, 2, 1, 12, 0, 0),
    )


@query(
    """
    WITH p AS (SELECT o_orderkey AS k, o_orderdate AS d, c_nationkey AS n
               FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 <> 0),
    f AS (SELECT * FROM p WHERE k % 3 < 2),
    marks AS (SELECT n, max(d) AS mark FROM f GROUP BY 1),
    late AS (SELECT k, n, d + CASE WHEN k % 6 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS d FROM p),
    s AS (SELECT late.* FROM late LEFT JOIN marks ON late.n = marks.n
          WHERE CAST(d AS DATE) >= CAST(coalesce(mark, TIMESTAMP '1970-01-01') AS DATE))
    SELECT CAST(coalesce(f.k, s.k) AS VARCHAR) AS pull_id, coalesce(greatest(f.d, s.d), f.d, s.d) AS updated,
           coalesce(f.k, s.k) // 10000000 AS pull_block,
           CASE WHEN coalesce(f.k, s.k) % 2 = 0 THEN 1 ELSE 0 END AS reviews
    FROM f FULL JOIN s ON f.k = s.k
    """
)
def run_twice(spark, sf_dir):
    """Two runs, the second with new and updated pulls, under a policy with blocks of ids; the merged pulls.

    Organizations and repositories in scope are the regions and nations, as in ``run_everything``.
    """
    database, at = scratch_database(spark), datetime(2024, 2, 1, 12, 0, 0)
    scope = [[r[0] for r in table(spark, sf_dir, t).select(c).collect()] for t, c in (("region", "r_name"), ("nation", "n_name"))]
    specs = {pulls.TABLE: PULLS_IN_BLOCKS}
    for landing in (landing_of(spark, sf_dir, "o_orderkey % 3 < 2"), landing_of(spark, sf_dir, late="o_orderkey % 6 = 0")):
        run_all(spark, database, landing, *scope, at=at, specs=specs)
    stored = catalog.read(spark, f"{database}.{pulls.TABLE}")
    return stored.select("pull_id", "time.updated", "pull_block", F.coalesce(F.array_size("reviews"), F.lit(0)).alias("reviews"))


def spoiled(texts, body: str, when: str):
    """Landed texts of which those that ``when`` holds for cannot be read; it sees the number as ``k``."""
    k = F.expr(when.replace("k", "cast(pull_number as bigint)"))
    return texts.withColumn(body, F.when(k, F.lit("not json")).otherwise(F.col(body)))


@query(
    """
    WITH p AS (SELECT o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey),
    judged AS (
        SELECT k, CASE WHEN k % 9 = 0 AND k % 18 <> 0 THEN 'missing author' WHEN k % 28 = 0 THEN 'unreadable reviews'
                       WHEN k % 20 = 13 THEN 'unreadable details' END AS reason
        FROM p)
    SELECT CAST(k AS VARCHAR) AS pull_number, reason AS reject_reason,
           CASE WHEN reason IS NULL THEN CAST(k % 5 AS INTEGER) END AS comments,
           CASE WHEN reason IS NOT NULL THEN TIMESTAMP '2024-02-01 12:00:00' END AS held_since,
           CAST(0 AS BIGINT) AS changes_of_third_run
    FROM judged
    """
)
def quarantine_replay(spark, sf_dir):
    """three runs over bad details, reviews and authors; where every pull is after the last.

    The second run brings some of what was unreadable in a form that can be read, for pulls whose
    marks have long passed and, for every third, that are not even listed again. Those are stored
    and no longer held; what stays bad is held with its reason since the first run. The
    third run lands the same again and changes nothing.
    """
    database = scratch_database(spark)
    scope = [[r[0] for r in table(spark, sf_dir, t).select(c).collect()] for t, c in (("region", "r_name"), ("nation", "n_name"))]

    def landed(listed, authors, bad_details, bad_reviews):
        every = landing_of(spark, sf_dir, authors=authors)
        return Landing(
            orgs=every.orgs,
            pulls=landing_of(spark, sf_dir, keep=listed, authors=authors).pulls,
            details=spoiled(every.details, "detail", bad_details),
            reviews=spoiled(every.reviews, "reviews", bad_reviews),
        )

    first = landed("true", "o_orderkey % 9 <> 0", "k % 10 = 3", "k % 14 = 0")
    later = landed("o_orderkey % 3 <> 0 or o_orderkey % 18 = 0", "o_orderkey % 9 <> 0 or o_orderkey % 18 = 0", "k % 20 = 13", "k % 28 = 0")
    for day, landing in enumerate((first, later, later), 1):
        counts = run_all(spark, database, landing, *scope, at=datetime(2024, 2, day, 12, 0, 0))
    changes = counts.filter(F.col("table_name") == pulls.TABLE).first()["num_affected_rows"]
    stored = catalog.read(spark, f"{database}.{pulls.TABLE}")
    held = quarantine.read_held(spark, f"{database}.{PULL_REJECTS}")
    return (
        stored.select("pull_number", F.lit(None).cast("string").alias("reject_reason"), F.col("metrics.comment_count").alias("comments"), F.lit(None).cast("timestamp_ntz").alias("held_since"))
        .unionByName(held.select("pull_number", "reject_reason", F.lit(None).cast("int").alias("comments"), "held_since"))
        .withColumn("changes_of_third_run", F.lit(changes).cast("bigint"))
    )


@query(
    """
    SELECT CAST(o_custkey % 20 AS VARCHAR) AS repo_id, max(o_orderdate + CASE WHEN o_orderkey % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END) AS mark
    FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1
    """
)
def maintained_marks(spark, sf_dir):
    """A4: marks kept in a table and moved on by each merge, not computed from what is stored.

    A first merge, new pulls, updates, and a batch of versions older than those stored.
    """
    orders = table(spark, sf_dir, "orders")
    database = scratch_database(spark)
    name, kept = f"{database}.pulls", f"{database}.marks"

    def merge(keep, days):
        updated = F.col("o_orderdate") + F.expr(f"interval {days} day")
        rows = orders.filter(keep).select(
            (F.col("o_custkey") % 20).cast("string").alias("repo_id"),
            F.col("o_orderkey").cast("string").alias("pull_id"),
            F.struct(updated.alias("updated")).alias("time"),
        )
        catalog.merge_into(rows, name, PULLS)
        marks.advance_marks(rows, kept, ("repo_id",), "time.updated")

    merge("o_orderkey % 3 = 1", 0)
    merge("o_orderkey % 3 <> 1", 0)
    merge("o_orderkey % 7 = 0", 3)
    merge("o_orderkey % 7 = 0", 1)
    return marks.read_marks(spark, kept, name, ("repo_id",), "time.updated")


@query(
    """
    WITH users AS (
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, c_custkey AS k,
               CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS UBIGINT) % 128 AS INTEGER) AS bucket
        FROM customer WHERE c_custkey IS NOT NULL),
    moved AS (SELECT *, k BETWEEN 100 AND 120 AND k % 10 < 9 AS renamed, k BETWEEN 200 AND 260 AND k % 10 = 9 AS new FROM users)
    SELECT user_id, CASE WHEN renamed THEN upper(name) || '!' ELSE name END AS user_name, bucket,
           bool_or(renamed OR new) OVER (PARTITION BY bucket) AS replaced
    FROM moved WHERE k % 10 < 9 OR new
    """
)
def bucketed_renames(spark, sf_dir):
    """M6: a table in hidden buckets of its keys' hash; which files some renames and new users replace."""
    users = table(spark, sf_dir, "customer").filter("c_custkey is not null")
    key, name = F.col("c_custkey"), f"{scratch_database(spark)}.users"
    spec = replace(USERS, buckets=128)

    def rows(df, title):
        return df.select(key.cast("string").alias("user_id"), title.alias("user_name"))

    catalog.merge_into(rows(users.filter(key % 10 < 9), F.col("c_name")), name, spec)
    files = F.col("_metadata.file_path").alias("file")
    before = stage(catalog.read_raw(spark, name).select(files).distinct(), "files")
    renamed = rows(users.filter((key % 10 < 9) & key.between(100, 120)), F.concat(F.upper("c_name"), F.lit("!")))
    new = rows(users.filter((key % 10 == 9) & key.between(200, 260)), F.col("c_name"))
    catalog.merge_into(renamed.unionByName(new), name, spec)
    stored = catalog.read_raw(spark, name)
    bucket = F.col(catalog.bucket_column(stored.columns)).alias("bucket")
    kept = before.withColumn("kept", F.lit(True))
    return stored.select("user_id", "user_name", bucket, files).join(kept, "file", "left").select(
        "user_id", "user_name", "bucket", F.col("kept").isNull().alias("replaced")
    )


@query(
    """
    WITH monthly AS (
        SELECT CAST(l_suppkey AS VARCHAR) AS org_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
               count(*) AS lines, count(*) FILTER (l_returnflag = 'A') AS seen
        FROM lineitem GROUP BY 1, 2)
    SELECT org_id, dt, CASE WHEN dt >= DATE '1998-07-01' THEN lines ELSE seen END AS repo_count,
           dt >= DATE '1998-07-01' AND dt < DATE '1999-01-01' AS replaced
    FROM monthly
    """
)
def snapshot_days(spark, sf_dir):
    """M1: snapshots merged into a table partitioned by their day; which days' files were replaced.

    The days both merges bring are written anew, later ones are added, earlier ones stay.
    """
    name = f"{scratch_database(spark)}.orgs"
    monthly = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("org_id"), F.trunc("l_shipdate", "month").alias("dt"))
        .agg(F.count("*").alias("lines"), F.count_if(F.col("l_returnflag") == "A").alias("seen"))
    )
    monthly = stage(monthly, "monthly-orgs")
    catalog.merge_into(monthly.filter("dt < DATE '1999-01-01'").select("org_id", F.col("seen").alias("repo_count"), "dt"), name, ORG_SNAPSHOT)
    files = F.col("_metadata.file_path").alias("file")
    before = stage(catalog.read(spark, name).select("dt", files).distinct(), "files")
    catalog.merge_into(monthly.filter("dt >= DATE '1998-07-01'").select("org_id", F.col("lines").alias("repo_count"), "dt"), name, ORG_SNAPSHOT)
    now = catalog.read(spark, name).select("org_id", "dt", "repo_count", files)
    gone = before.join(now.select("file").distinct(), "file", "left_anti").select("dt").distinct().withColumn("gone", F.lit(True))
    return now.join(gone, "dt", "left").select("org_id", "dt", "repo_count", F.col("gone").isNotNull().alias("replaced"))


@query(
    """
    WITH now AS (
        SELECT o_custkey % 40 AS repo, o_totalprice,
               o_orderdate + CASE WHEN o_custkey % 40 < 6 AND o_orderkey % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS updated
        FROM orders WHERE o_custkey IS NOT NULL AND (o_orderkey % 8 < 7 OR o_custkey % 40 = 39))
    SELECT CAST(repo AS VARCHAR) AS repo_id, count(*) AS pulls, max(updated) AS newest,
           CAST(count(*) FILTER (updated >= TIMESTAMP '1998-01-01') AS BIGINT) AS recent,
           CAST(7 AS BIGINT) AS groups_folded_again
    FROM now GROUP BY repo
    """
)
def derived_from_changes(spark, sf_dir):
    """D3: a table of groups, brought up to date from the keys that a merge changed.

    Updates in six repositories and new pulls in a seventh: only these are folded again.
    """
    database = scratch_database(spark)
    orders = table(spark, sf_dir, "orders").filter("o_custkey is not null")
    repo = F.col("o_custkey") % 40

    def rows(df, days):
        updated = F.col("o_orderdate") + F.expr(f"interval {days} day")
        return df.select(
            repo.cast("string").alias("repo_id"),
            F.col("o_orderkey").cast("string").alias("pull_id"),
            F.struct(updated.alias("updated")).alias("time"),
        )

    def fold(pulls):
        recent = F.count_if(F.col("time.updated") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        return pulls.groupBy("repo_id").agg(F.count("*").alias("pulls"), F.max("time.updated").alias("newest"), recent.alias("recent"))

    base = f"{database}.pulls"
    derived = GroupedTable(f"{database}.repo_pulls", base, ("repo_id",), fold)
    catalog.merge_into(rows(orders.filter("o_orderkey % 8 < 7"), 0), base, PULLS)
    derived.refresh(spark)
    changed = rows(orders.filter((repo < 6) & F.expr("o_orderkey % 3 = 0 and o_orderkey % 8 < 7")), 1)
    new = rows(orders.filter((repo == 39) & (F.expr("o_orderkey % 8 = 7"))), 0)
    with catalog.merging(changed.unionByName(new), base, PULLS) as merged:
        groups = derived.fold(derived.touched(merged.changes)).count()
        derived.refresh(spark, merged.changes)
    return catalog.read(spark, derived.name).withColumn("groups_folded_again", F.lit(groups).cast("bigint"))


@query(
    """
    WITH p AS (SELECT o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 <> 0 AND o_orderkey % 3 < 2)
    SELECT t AS table_name, CAST(n AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS files_changed, true AS failed
    FROM (SELECT 'source_orgs' AS t, count(*) AS n FROM region UNION ALL SELECT 'users', count(*) FROM nation
          UNION ALL SELECT 'source_pulls', count(*) FROM p UNION ALL SELECT 'expectations', count(*) FROM part)
    """
)
def run_all_or_none(spark, sf_dir):
    """A run whose landing holds one bad expectation document leaves every table as it was."""
    database = scratch_database(spark)
    scope = [table(spark, sf_dir, t).select(c) for t, c in (("region", "r_name"), ("nation", "n_name"))]

    def landed(bad: str, **how):
        docs = schema_docs(spark, sf_dir)
        spoilt = F.when((F.col("p_partkey") == 3) & F.expr(bad), F.lit('{"title": null}')).otherwise(F.col("value"))
        return replace(landing_of(spark, sf_dir, **how), repos=None, contributors=None, expectations=docs.select(spoilt.alias("value")))

    def files():
        return {t: set(catalog.read(spark, f"{database}.{t}").inputFiles()) for t in ("source_orgs", "source_pulls", "expectations", "users")}

    run_all(spark, database, landed("false", keep="o_orderkey % 3 < 2"), *scope, at=datetime(2024, 2, 1, 12, 0, 0))
    before, failed = files(), False
    try:
        run_all(spark, database, landed("true", late="o_orderkey % 6 = 0"), *scope, at=datetime(2024, 2, 2, 12, 0, 0))
    except Exception as error:  # Spark's, from the document
        failed = "no title in document" in str(error)
    changed = {t: len(before[t] ^ now) for t, now in files().items()}
    rows = [
        catalog.read(spark, f"{database}.{t}").agg(F.count("*").alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count", F.lit(n).cast("bigint").alias("files_changed"), F.lit(failed).alias("failed"))
        for t, n in changed.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query(
    """
    SELECT count(*) AS row_count,
           CAST(min(l_orderkey) AS VARCHAR) AS min_l_orderkey, CAST(max(l_orderkey) AS VARCHAR) AS max_l_orderkey,
           CAST(min(l_linenumber) AS VARCHAR) AS min_l_linenumber, CAST(max(l_linenumber) AS VARCHAR) AS max_l_linenumber,
           CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS min_day, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS max_day,
           min(l_returnflag) AS min_l_returnflag, max(l_returnflag) AS max_l_returnflag,
           CAST(date_trunc('year', min(l_shipdate)) AS DATE)::VARCHAR AS min_year, CAST(date_trunc('year', max(l_shipdate)) AS DATE)::VARCHAR AS max_year
    FROM lineitem
    """
)
def profile_from_footers(spark, sf_dir):
    """Count and extremes of a table from file footers and its list of partitions; text is scanned."""
    name = f"{scratch_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), "l_returnflag", F.trunc("l_shipdate", "year").alias("year"))
    catalog.create_as(lines, name, ("year",))
    return profiles.footer_profile(spark, name, ["l_orderkey", "l_linenumber", "day", "l_returnflag", "year"])


@query(
    """
    SELECT * FROM (
        SELECT 'l_orderkey' AS "column", count(DISTINCT l_orderkey) AS distinct_count FROM lineitem
        UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
        UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
        UNION ALL SELECT 'day', count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem
        UNION ALL SELECT 'wide', count(DISTINCT l_orderkey % 1000) FROM lineitem)
    """
)
def distinct_by_bitmaps(spark, sf_dir):
    """Exact distinct counts of several integer columns in one pass; one of them is spread too wide for bitmaps."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day"), (F.col("l_orderkey") % 1000 * 10**15).alias("wide"))
    return profiles.distinct_counts(lines, ["l_orderkey", "l_partkey", "l_suppkey", "day", "wide"])


@query(
    """
    WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    seen AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events)
    SELECT d.day AS day, count(DISTINCT s.user_id) FILTER (s.day = d.day) AS users_of_day, count(DISTINCT s.user_id) AS users_so_far
    FROM days AS d JOIN seen AS s ON s.day <= d.day AND date_trunc('month', s.day) = date_trunc('month', d.day)
    GROUP BY d.day
    """
)
def distinct_over_days(spark, sf_dir):
    """A2: distinct users of each day and of its month so far, from bitmaps that were built once per day."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "user_id")
    bitmaps = stage(profiles.column_bitmaps(days, ["user_id"], by=("day",)), "bitmaps")
    # A bitmap goes to each later day of its month: at most 31 rows of it.
    later = F.explode(F.sequence(F.col("day"), F.last_day("day"))).alias("until")
    so_far = bitmaps.select(later, "column", "bucket", "bitmap")
    of_month = profiles.distinct_of_bitmaps(so_far, ("until",)).select(F.col("until").alias("day"), F.col("distinct_count").alias("users_so_far"))
    of_day = profiles.distinct_of_bitmaps(bitmaps, ("day",)).select("day", F.col("distinct_count").alias("users_of_day"))
    return of_day.join(of_month, "day")
