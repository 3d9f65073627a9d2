"""Repository snapshots: one row per repository and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import pack
from tidemark.functions.text import url_map
from tidemark.sources import landed

TABLE = "source_repos"

# The counters kept of a repository record.
COUNTERS = (
    "watchers_count",
    "open_issues_count",
    "stargazers_count",
    "subscribers_count",
    "network_count",
    "forks_count",
)


def repo_records(landed_repos: DataFrame, dt: date | Column) -> DataFrame:
    """Typed rows with their URLs, from landed texts (org_id, org_name, repo_name, repo).

    A counter may be a number or text; one that is not an int is an error, never a NULL.
    """
    parsed = landed_repos.select("*", F.from_json("repo", "map<string,string>").alias("fields"))
    return parsed.select(
        "org_id",
        "org_name",
        landed.required(landed.whole_number(F.col("fields")["id"]), F.col("repo_name"), "no id for repository").cast("string").alias("repo_id"),
        "repo_name",
        url_map(F.col("fields")).alias("urls"),
        pack(**{c: _counter(F.col("fields")[c], c) for c in COUNTERS}).alias("metrics"),
        (dt if isinstance(dt, Column) else F.lit(dt)).cast("date").alias("dt"),
    )


def _counter(text: Column, name: str) -> Column:
    wrong = F.raise_error(F.concat(F.lit(f"unreadable {name}: "), text)).cast("int")
    return F.when(landed.is_unreadable(text, "int"), wrong).otherwise(landed.whole_number(text, "int"))


def repo_snapshot(landed_repos: DataFrame, dt: date | Column) -> DataFrame:
    """Snapshot rows as stored, without URLs."""
    return repo_records(landed_repos, dt).drop("urls")


def url_names(records: DataFrame) -> DataFrame:
    """Each repository's URL names, sorted."""
    return records.select("repo_id", F.array_sort(F.map_keys("urls")).alias("url_names"))
