"""Which organizations and repositories a run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame


class UnknownNames(ValueError):
    """Names were asked for that the source does not list."""


def scope_pairs(listed: DataFrame, orgs: DataFrame, repos: DataFrame) -> DataFrame:
    """Listed (org_name, repo_name) pairs whose org and repo are both configured.

    The same pairs as crossing the two lists and keeping what an org lists, without
    forming the product.
    """
    return (
        listed.select("org_name", "repo_name")
        .distinct()
        .join(orgs.select("org_name").distinct(), "org_name", "left_semi")
        .join(repos.select("repo_name").distinct(), "repo_name", "left_semi")
        .select("org_name", "repo_name")
    )


def unknown_names(requested: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Requested names that are not known."""
    return requested.select(*columns).distinct().join(known.select(*columns).distinct(), columns, "left_anti")


def require_known(requested: DataFrame, known: DataFrame, columns: list[str]) -> None:
    sample = unknown_names(requested, known, columns).limit(5).collect()
    if sample:
        raise UnknownNames(f"not found: {[tuple(r) for r in sample]}")
