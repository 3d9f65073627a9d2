"""Pull requests: typed rows with details and reviews."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import none_if_empty, pack, times_in_struct
from tidemark.functions.text import spaced
from tidemark.functions.times import is_malformed_time, run_time, to_time
from tidemark.operators.incremental import reject_reason, split_rejects
from tidemark.sources import landed

TABLE = "source_pulls"
IDS = ("org_id", "org_name", "repo_id", "repo_name")
PULL = ("repo_id", "pull_number")
TIMES = ["created", "updated", "closed", "merged"]
# How a pull that was set aside is known again, and what is kept of it.
IDENTITIES = (("repo_id", "pull_number"), ("repo_id", "pull_id"))
HELD = (*IDS, "pull_id", "pull_number", "title", "user_id", "labels", "is_draft", "time")


def pull_records(pages: DataFrame) -> DataFrame:
    """One row (ids, record) per pull from landed pages (ids, page)."""
    return landed.explode_pages(pages, "page", landed.PULLS, keep=IDS)


def pull_details(texts: DataFrame) -> DataFrame:
    """Counts of each pull from landed texts (repo_id, pull_number, detail).

    ``details_unreadable`` tells a text that is no JSON object, or a count that is no int.
    """
    parsed = texts.select(*PULL, F.from_json("detail", "map<string,string>").alias("d"))
    count = {name: F.col("d")[name] for name in landed.PULL_DETAIL}
    unreadable = reduce(lambda a, b: a | b, [landed.is_unreadable(c, "int") for c in count.values()])
    number = {name: landed.whole_number(c, "int") for name, c in count.items()}
    return parsed.select(
        *PULL,
        pack(
            comment_count=number["comments"],
            review_comment_count=number["review_comments"],
            commit_count=number["commits"],
            changed_file_count=number["changed_files"],
        ).alias("metrics"),
        (F.col("d").isNull() | unreadable).alias("details_unreadable"),
    )


def pull_reviews(texts: DataFrame) -> DataFrame:
    """Reviews of each pull from landed texts (repo_id, pull_number, reviews), one row a page.

    Pages of one pull are concatenated, in an order of their own hashes; the list is bounded by
    the pull. The join that follows has the same keys, so that this moves nothing twice.
    """
    parsed = texts.select(*PULL, F.xxhash64("reviews").alias("at"), F.from_json("reviews", landed.REVIEWS).alias("reviews"))
    pages = parsed.groupBy(*PULL).agg(
        F.array_sort(F.collect_list(F.struct("at", "reviews"))).alias("pages"), F.bool_or(F.col("reviews").isNull()).alias("unreadable")
    )
    reviews = F.flatten(F.transform("pages", lambda p: p["reviews"]))
    return pages.select(*PULL, review_list(reviews).alias("reviews"), F.col("unreadable").alias("reviews_unreadable"))


def review_list(reviews: Column) -> Column:
    return F.transform(
        reviews,
        lambda r: pack(
            review_id=r["id"].cast("string"),
            user_id=r["user"]["id"].cast("string"),
            action=spaced(r["state"]),
            submitted=r["submitted_at"],
        ),
    )


def review_rollup(reviews: DataFrame, keys: tuple[str, ...], submitted: str, action: str) -> DataFrame:
    """Counts and times of flat review rows per pull.

    Plain aggregates, combined before the shuffle: a pull with very many reviews is
    never gathered in one place.
    """
    return reviews.groupBy(*keys).agg(
        F.count("*").alias("review_count"),
        F.count_if(spaced(F.col(action)) == "approved").alias("approval_count"),
        F.min(submitted).alias("first_submitted"),
        F.max(submitted).alias("last_submitted"),
    )


def in_blocks(pulls: DataFrame, ids_per_block: int = 10_000_000) -> DataFrame:
    """Pulls with the block their id lies in, for ``policies.PULLS_IN_BLOCKS``.

    Ids grow with time and updates mostly concern recent pulls, so most blocks of even
    the largest repository stay as they are.
    """
    block = F.floor(F.col("pull_id").cast("bigint") / ids_per_block)
    return pulls.withColumn("pull_block", block)


def with_details(pulls: DataFrame, details: DataFrame, reviews: DataFrame) -> DataFrame:
    """Each pull with its counts and its list of reviews; a missing list is empty."""
    return pulls.join(details, list(PULL), "left").join(reviews, list(PULL), "left")


def pull_rows(records: DataFrame, at: datetime | None = None) -> DataFrame:
    """Cleaned rows (ids, record) with times still as text; not yet with details."""
    r = "record."
    return records.select(
        run_time(at).alias("api_request_time"),
        *IDS,
        landed.whole_number(F.col(r + "id")).cast("string").alias("pull_id"),
        landed.whole_number(F.col(r + "number")).cast("string").alias("pull_number"),
        F.col(r + "title").alias("title"),
        F.col(r + "user.id").cast("string").alias("user_id"),
        F.col(r + "labels.name").alias("labels"),
        F.coalesce(r + "draft", F.lit(False)).alias("is_draft"),
        pack(
            created=F.col(r + "created_at"),
            updated=F.col(r + "updated_at"),
            closed=F.col(r + "closed_at"),
            merged=F.col(r + "merged_at"),
        ).alias("time"),
    )


def of_run(rows: DataFrame, at: datetime | None = None) -> DataFrame:
    """Rows kept by an earlier run (columns ``HELD``) as rows of this one."""
    return rows.select(run_time(at).alias("api_request_time"), *HELD)


def pull_reject_reason() -> Column:
    """Why a detailed pull row cannot be stored: a part of its identity or its author is
    missing or unreadable, a time, its details or a review is bad."""
    times = {f"{t} time": F.col("time")[t] for t in TIMES}
    review = F.when(F.col("reviews_unreadable"), F.lit("unreadable reviews")).when(
        F.exists("reviews", lambda v: v["user_id"].isNull()), F.lit("missing reviewer")
    ).when(
        F.exists("reviews", lambda v: is_malformed_time(v["submitted"])), F.lit("malformed review time")
    )
    needed = {"author": "user_id", "id": "pull_id", "number": "pull_number", "repository": "repo_id"}
    details = F.when(F.col("details_unreadable"), F.lit("unreadable details"))
    return F.coalesce(reject_reason({name: F.col(c) for name, c in needed.items()}, times), review, details)


def pull_facts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed pull rows, rejects) from rows with details. Empty lists become NULL."""
    return judged_facts(with_reason(rows))


def with_reason(rows: DataFrame) -> DataFrame:
    """Rows with details and why each cannot be stored, NULL if it can."""
    return rows.withColumn("reject_reason", pull_reject_reason())


def judged_facts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pull_facts`` of rows whose reason is a column already."""
    good, rejects = split_rejects(rows, F.col("reject_reason"))
    return typed_pulls(good), rejects


def typed_pulls(rows: DataFrame) -> DataFrame:
    reviews = F.transform(
        "reviews",
        lambda v: pack(
            review_id=v["review_id"],
            user_id=v["user_id"],
            action=v["action"],
            submitted=to_time(v["submitted"]),
        ),
    )
    return rows.select(
        to_time(F.col("api_request_time")).alias("api_request_time"),
        *IDS,
        "pull_id",
        "pull_number",
        "title",
        "user_id",
        none_if_empty(F.col("labels")).alias("labels"),
        "is_draft",
        times_in_struct(F.col("time"), TIMES).alias("time"),
        "metrics",
        F.when(F.array_size("reviews") > 0, reviews).alias("reviews"),
    )
