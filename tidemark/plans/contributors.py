"""Contributor activity: weekly counts folded to one row per contributor."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import fold_to_int, pack
from tidemark.functions.times import run_time, to_day, to_time, unix_day_text
from tidemark.operators.incremental import reject_reason
from tidemark.sources import landed

TABLE = "source_contributors"
IDS = ("org_id", "org_name", "repo_id", "repo_name")
# How a contributor that was set aside is known again, and what is kept of it.
IDENTITIES = (("repo_id", "user_id"),)
HELD = (*IDS, "user_id", "user_name", "activity")


def contributor_records(pages: DataFrame, at: datetime | None = None) -> DataFrame:
    """One row per contributor from landed pages (ids, page), weeks without activity dropped."""
    texts = landed.explode_pages(pages, "page", landed.CONTRIBUTORS, keep=IDS)
    weeks = F.transform("record.weeks", lambda w: pack(**{c: landed.whole_number(w[c]) for c in "wadc"}))
    return active_weeks(texts.select(*IDS, pack(author=F.col("record.author"), weeks=weeks).alias("record")), at)


def active_weeks(records: DataFrame, at: datetime | None = None) -> DataFrame:
    """Records (ids, record) with their active weeks as an array of dated counts.

    ``weeks_unreadable`` tells a week without its day or one of its counts; its record must
    not be stored, because the week would be missing from the sums.
    """
    unreadable = F.exists("record.weeks", lambda w: w["w"].isNull() | (w["a"] + w["d"] + w["c"]).isNull())
    active = F.filter("record.weeks", lambda w: (w["a"] + w["d"] + w["c"]) > 0)
    return records.select(
        run_time(at).alias("api_request_time"),
        *IDS,
        F.col("record.author.id").cast("string").alias("user_id"),
        F.col("record.author.login").alias("user_name"),
        F.transform(
            active,
            lambda w: pack(week=unix_day_text(w["w"]), adds=w["a"], deletes=w["d"], commits=w["c"]),
        ).alias("activity"),
        F.coalesce(unreadable, F.lit(False)).alias("weeks_unreadable"),
    )


def contributor_reject_reason() -> Column:
    unreadable = F.when(F.col("weeks_unreadable"), F.lit("unreadable week"))
    return F.coalesce(reject_reason({"author": F.col("user_id"), "repository": F.col("repo_id")}, {}), unreadable)


def contributor_rollup(records: DataFrame) -> DataFrame:
    """First and last week and the sums of each contributor; map-only.

    A contributor with no active week stays, with no dates and zero counts.
    """
    return records.select(
        to_time(F.col("api_request_time")).alias("api_request_time"),
        *IDS,
        "user_id",
        "user_name",
        to_day(F.array_min("activity.week")).alias("first_week"),
        to_day(F.array_max("activity.week")).alias("last_week"),
        pack(
            weeks=F.array_size("activity"),
            lines_added=fold_to_int(F.col("activity.adds")),
            lines_deleted=fold_to_int(F.col("activity.deletes")),
            commits=fold_to_int(F.col("activity.commits")),
        ).alias("activity"),
    )
