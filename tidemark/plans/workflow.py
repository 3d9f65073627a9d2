"""One run over everything in scope: one merge per table, not one per repository; all tables or none."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial, reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import policies
from tidemark.operators.incremental import Mode, load, split_rejects
from tidemark.operators.merge import METRICS, MergeSpec, check_columns, check_unique
from tidemark.operators.scope import require_known, scope_pairs
from tidemark.operators.sizing import any_null, fits_broadcast
from tidemark.plans import contributors, expectations, orgs, pulls, repos, users
from tidemark.sources import catalog, marks, quarantine
from tidemark.sources.staging import staged
from tidemark.streaming.intake import newest_per_key

T = TypeVar("T")

# Landed kinds and the columns of their JSON lines; bodies are JSON texts as received.
KINDS = {
    "orgs": "org_name string, org string, members string, repos string",
    "repos": "org_name string, repo_name string, repo string",
    "contributors": "org_name string, repo_name string, page string",
    "pulls": "org_name string, repo_name string, page string",
    "details": "org_name string, repo_name string, pull_number string, detail string",
    "reviews": "org_name string, repo_name string, pull_number string, reviews string",
    "expectations": "value string",
}
# Merge policies by table; ``users`` declares its own.
SPECS = {
    orgs.TABLE: policies.ORG_SNAPSHOT,
    repos.TABLE: policies.REPO_SNAPSHOT,
    contributors.TABLE: policies.CONTRIBUTORS,
    pulls.TABLE: policies.PULLS,
    expectations.TABLE: policies.EXPECTATIONS,
}
TABLES = (orgs.TABLE, repos.TABLE, contributors.TABLE, pulls.TABLE, expectations.TABLE, "users")
# Beside them: marks of pulls, and records set aside.
MARKS, MARK_GROUPS, MARK_FIELD = "pull_marks", ("org_id", "repo_id"), "time.updated"
PULL_REJECTS, CONTRIBUTOR_REJECTS = "pull_rejects", "contributor_rejects"
SIDE_TABLES = (MARKS, PULL_REJECTS, CONTRIBUTOR_REJECTS)


@dataclass(frozen=True)
class Landing:
    """Landed texts of one run; a kind that was not landed is None."""

    orgs: DataFrame
    repos: DataFrame | None = None
    contributors: DataFrame | None = None
    pulls: DataFrame | None = None
    details: DataFrame | None = None
    reviews: DataFrame | None = None
    expectations: DataFrame | None = None


def read_landing(spark: SparkSession, root: str, kinds: list[str] | None = None) -> Landing:
    """JSON-lines folders below ``root``, one per kind."""
    return Landing(**{k: spark.read.schema(KINDS[k]).json(f"{root}/{k}") for k in kinds or KINDS})


@dataclass(frozen=True)
class Ready:
    """Rows of one table, staged before any table is touched, and what follows their merge."""

    table: str
    rows: DataFrame
    rejects: DataFrame | None = None
    then: Callable[[], object] = lambda: None


def run_all(
    spark: SparkSession,
    database: str,
    landing: Landing,
    org_names: list[str] | DataFrame,
    repo_names: list[str] | DataFrame,
    at: datetime | None = None,
    mode: Mode = "new",
    specs: dict[str, MergeSpec] | None = None,
) -> DataFrame:
    """Upsert every table for the configured organizations and repositories, or none.

    The rows of all tables are staged and checked first; a landing that cannot be read, or
    that brings a key twice, fails before any table changes. ``org_names`` and ``repo_names`` are
    lists or frames with that one column. ``specs`` replaces the merge policies of tables named in
    it; a policy for pulls that is partitioned by ``pull_block`` gets pulls divided into blocks.
    Returns the merge counts of each table and how many records were set aside.
    """
    spec = {**SPECS, **(specs or {})}
    at = at or datetime.now(timezone.utc)
    configured, wanted = _names(spark, org_names, "org_name"), _names(spark, repo_names, "repo_name")
    require_known(configured, landing.orgs, ["org_name"])
    with ExitStack() as files:

        def keep(df: DataFrame, label: str) -> DataFrame:
            return files.enter_context(staged(df, label))

        landed_orgs = landing.orgs.join(configured, "org_name", "left_semi")
        snapshot = keep(orgs.org_snapshot(orgs.whole_orgs(landed_orgs), at.date()), "orgs")
        listed = orgs.listed_repos(snapshot)
        pairs = scope_pairs(listed, configured, wanted)
        scope = keep(listed.join(pairs, ["org_name", "repo_name"], "left_semi"), "scope")
        steps = [lambda: Ready(orgs.TABLE, snapshot), *_repo_steps(spark, database, landing, scope, at, mode, spec, keep)]
        if landing.expectations is not None:
            docs = landing.expectations  # texts, or documents kept as variant
            core = expectations.core_of_documents(docs) if "doc" in docs.columns else expectations.core_expectations(docs)
            steps.append(lambda: Ready(expectations.TABLE, keep(core, "expectations")))
        # Tables have nothing to do with each other, so their many small jobs need not wait in line.
        ready = at_once([partial(_checked, spark, database, step, spec) for step in steps])
        report = at_once([partial(_merged, spark, database, r, spec[r.table]) for r in ready])

        table = users.users_table(f"{database}.users", f"{database}.{orgs.TABLE}")
        if table.build(spark).isEmpty():  # nobody is listed on the latest day: nothing to merge
            counts = spark.createDataFrame([(0, 0, 0, 0)], METRICS)
        else:
            counts = table.refresh(spark)
        report.append(counts.withColumn("table_name", F.lit("users")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), report)


def _names(spark: SparkSession, names: list[str] | DataFrame, column: str) -> DataFrame:
    if isinstance(names, DataFrame):
        return names.select(F.col(names.columns[0]).cast("string").alias(column))
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


def at_once(steps: list[Callable[[], T]]) -> list[T]:
    """The results of all steps, run side by side; all are over before an error is raised."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(step)) for step in steps]
    return [r.result() for r in running]


def _repo_steps(spark, database, landing, scope, at, mode, spec, keep) -> list[Callable[[], Ready]]:
    """What makes the rows of everything below a repository, each over all repositories at once."""

    def in_scope(texts: DataFrame) -> DataFrame:
        return texts.join(scope, ["org_name", "repo_name"])

    def ready_repos() -> Ready:
        return Ready(repos.TABLE, keep(repos.repo_snapshot(in_scope(landing.repos), at.date()), "repos"))

    def ready_contributors() -> Ready:
        records = keep(contributors.contributor_records(in_scope(landing.contributors), at), "contributors")
        good, rejects = split_rejects(records, contributors.contributor_reject_reason())

        def hold():
            held = quarantine.held_rows(rejects, contributors.IDENTITIES, contributors.HELD, at)
            quarantine.settle(spark, f"{database}.{CONTRIBUTOR_REJECTS}", held, good, contributors.IDENTITIES)

        return Ready(contributors.TABLE, contributors.contributor_rollup(good), rejects, hold)

    def ready_pulls() -> Ready:
        # Fresh pulls first: only their details and reviews are parsed. All is frozen before it
        # is split, so that both halves see the same rows.
        fresh = keep(_fresh_pulls(spark, database, landing, in_scope, at, mode), "fresh")
        taken = _with_waiting(spark, database, landing, in_scope, fresh, at, mode, keep)
        facts, bad = _judged_pulls(_detailed_pulls(landing, in_scope, taken), keep)
        facts = _newest_landing(facts, keep)
        if "pull_block" in spec[pulls.TABLE].partition_by:
            facts = pulls.in_blocks(facts)

        def hold():
            marks.advance_marks(facts, f"{database}.{MARKS}", MARK_GROUPS, MARK_FIELD)
            held = quarantine.held_rows(bad, pulls.IDENTITIES, pulls.HELD, at)
            quarantine.settle(spark, f"{database}.{PULL_REJECTS}", held, facts, pulls.IDENTITIES)

        return Ready(pulls.TABLE, facts, bad, hold)

    steps = {ready_repos: landing.repos, ready_contributors: landing.contributors, ready_pulls: landing.pulls}
    return [step for step, texts in steps.items() if texts is not None]


def _judged_pulls(detailed: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """Typed pull rows and rejects, both staged: what follows reads them several times over, and
    the reasons and times would be worked out from texts and lists each time."""
    judged = keep(pulls.with_reason(detailed), "pulls")
    facts, bad = pulls.judged_facts(judged)
    return keep(facts, "facts"), bad


def _newest_landing(facts: DataFrame, keep) -> DataFrame:
    """Pulls landed several times in one run, as their newest version.

    Whole rows are grouped only if a narrow look at the keys finds one twice.
    """
    keys = SPECS[pulls.TABLE].keys
    twice = facts.filter(~any_null(keys)).groupBy(*keys).count().filter("count > 1")
    return facts if twice.isEmpty() else keep(newest_per_key(facts, keys, MARK_FIELD), "newest")


def _checked(spark, database, step: Callable[[], Ready], specs: dict[str, MergeSpec]) -> Ready:
    """Rows that can be merged into their table."""
    ready = step()
    spec = specs[ready.table]
    stored = catalog.read(spark, f"{database}.{ready.table}")
    if stored is not None:
        check_columns(stored, ready.rows, spec)
    if ready.table != pulls.TABLE:  # whose keys have been looked at
        check_unique(ready.rows, spec.keys)
    return ready


def delete_all(spark: SparkSession, database: str) -> DataFrame:
    """Drop every table of a run and report which ones existed; marks and rejects go with them."""
    for name in SIDE_TABLES:
        catalog.drop(spark, f"{database}.{name}")
    return catalog.drop_all(spark, [f"{database}.{t}" for t in TABLES])


def _fresh_pulls(spark, database, landing, in_scope, at, mode) -> DataFrame:
    """Pulls to take in: new ones, and those that an earlier run had to set aside."""
    rows = pulls.pull_rows(pulls.pull_records(in_scope(landing.pulls)), at)
    if mode == "sample":
        keyed = rows.withColumn("_key", F.concat_ws("/", "repo_id", "pull_id"))
        return load(keyed, "sample", key="_key", groups=MARK_GROUPS).drop("_key")
    held = quarantine.read_held(spark, f"{database}.{PULL_REJECTS}")
    known = marks.read_marks(spark, f"{database}.{MARKS}", f"{database}.{pulls.TABLE}", MARK_GROUPS, MARK_FIELD)
    if mode == "new" and known is not None:
        rows = quarantine.is_held(rows, held, pulls.IDENTITIES, "_held")
        return load(rows, "new", marks=known, groups=MARK_GROUPS, updated=F.col(MARK_FIELD), also=F.col("_held")).drop("_held")
    return rows


def _with_waiting(spark, database, landing, in_scope, fresh: DataFrame, at, mode, keep) -> DataFrame:
    """Fresh pulls, and those set aside that were not landed again, but details or reviews of them.

    The latter are staged: finding them looks at all landed details and reviews, which is done once.
    """
    held = quarantine.read_held(spark, f"{database}.{PULL_REJECTS}")
    bodies = [in_scope(b).select(*pulls.PULL) for b in (landing.details, landing.reviews) if b is not None]
    if mode == "sample" or held is None or not bodies:
        return fresh
    ddl = fresh.select(*pulls.HELD).schema.simpleString()
    waiting = quarantine.waiting_rows(held, reduce(DataFrame.unionByName, bodies), fresh, pulls.PULL, ddl)
    return fresh.unionByName(pulls.of_run(keep(waiting, "waiting"), at))


def _detailed_pulls(landing, in_scope, fresh: DataFrame) -> DataFrame:
    """Fresh pulls with their details and reviews; texts of other pulls are not parsed."""
    keys = fresh.select(*pulls.PULL).distinct()
    if fits_broadcast(keys):
        keys = F.broadcast(keys)

    def wanted(kind: str, body: str) -> DataFrame:
        texts = getattr(landing, kind)
        if texts is None:
            texts = fresh.sparkSession.createDataFrame([], KINDS[kind])
        return in_scope(texts).select(*pulls.PULL, body).join(keys, list(pulls.PULL), "left_semi")

    return pulls.with_details(fresh, pulls.pull_details(wanted("details", "detail")), pulls.pull_reviews(wanted("reviews", "reviews")))


def _merged(spark, database, ready: Ready, spec: MergeSpec) -> DataFrame:
    counts = catalog.merge_into(ready.rows, f"{database}.{ready.table}", spec, frozen=True)
    ready.then()
    if ready.rejects is not None:
        counts = counts.withColumn("num_rejected_rows", F.lit(ready.rejects.count()).cast("bigint"))
    return counts.withColumn("table_name", F.lit(ready.table))
