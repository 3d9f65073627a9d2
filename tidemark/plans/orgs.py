"""Organization snapshots: one row per organization and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import pack
from tidemark.functions.times import to_time
from tidemark.sources import landed

TABLE = "source_orgs"


def member_list(members: Column) -> Column:
    """Members as landed → array of (id, name), ids as text."""
    return F.transform(members, lambda m: pack(id=m["id"].cast("string"), name=m["login"]))


def repo_list(repos: Column) -> Column:
    """Repositories as landed → array of (id, name, flags, time)."""
    return F.transform(
        repos,
        lambda r: pack(
            id=r["id"].cast("string"),
            name=r["name"],
            is_private=r["private"],
            is_fork=r["fork"],
            is_archived=r["archived"],
            time=pack(
                pushed=to_time(r["pushed_at"]),
                created=to_time(r["created_at"]),
                updated=to_time(r["updated_at"]),
            ),
        ),
    )


def org_snapshot(landed_orgs: DataFrame, dt: date | Column) -> DataFrame:
    """Typed snapshot rows from landed texts (org_name, org, members, repos).

    Lists stay nested as they were landed, so no row is moved or grouped. A list that was
    landed but cannot be read, or not the id of one of its elements, is an error: members or
    repositories would vanish.
    """

    def listed(column: str, ddl: str) -> Column:
        whole = F.from_json(column, ddl)
        whole = F.when(~F.exists(whole, lambda e: e.isNull() | e["id"].isNull()), whole)
        return landed.readable(whole, F.col(column), f"unreadable {column}").alias(column)

    parsed = landed_orgs.select(
        "org_name",
        landed.parse_record(F.col("org"), landed.ORG).alias("org"),
        listed("members", landed.MEMBERS),
        listed("repos", landed.REPOS),
    )
    return parsed.select(
        landed.required(F.col("org.id"), F.col("org_name"), "no id for organization").cast("string").alias("org_id"),
        "org_name",
        member_list(F.col("members")).alias("members"),
        repo_list(F.col("repos")).alias("repos"),
        pack(
            public_repo_count=F.col("org.public_repos"),
            private_repo_count=F.col("org.owned_private_repos"),
            member_count=F.array_size("members"),
        ).alias("metrics"),
        (dt if isinstance(dt, Column) else F.lit(dt)).cast("date").alias("dt"),
    )


def whole_orgs(pages: DataFrame) -> DataFrame:
    """One row per organization from landed pages of its lists (columns as landed).

    Pages are concatenated in an order of their own hashes, so that a repeat gives the same list.
    The lists end in one row anyway, so that no group is larger than what it becomes. A page
    that is no list is left for ``org_snapshot`` to refuse.
    """

    def joined(column: str, ddl: str) -> Column:
        text = F.col(column)
        page = F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("at"), F.from_json(text, ddl).alias("part"), text.alias("text")))
        pages = F.array_sort(F.collect_list(page))
        unreadable = F.filter(pages, lambda p: p["part"].isNull() & (F.trim(p["text"]) != "null"))
        whole = F.to_json(F.flatten(F.transform(F.filter(pages, lambda p: p["part"].isNotNull()), lambda p: p["part"])))
        return F.when(F.size(unreadable) > 0, unreadable[0]["text"]).when(F.size(pages) > 0, whole).alias(column)

    return pages.groupBy("org_name").agg(F.max("org").alias("org"), joined("members", landed.MEMBERS), joined("repos", landed.REPOS))


def repo_names(orgs: DataFrame) -> DataFrame:
    """Each organization's repository names, sorted."""
    names = F.array_sort(F.transform("repos", lambda r: r["name"]))
    return orgs.select("org_id", "org_name", names.alias("repo_names"))


def listed_repos(orgs: DataFrame) -> DataFrame:
    """One row per repository an organization lists."""
    return orgs.select("org_id", "org_name", F.explode("repos").alias("repo")).select(
        "org_id", "org_name", F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name")
    )
