"""The merge policies of the engine's tables.

``partition_by`` suits tables of up to some thousands of repositories; with more, use
``dataclasses.replace(PULLS, partition_by=(), buckets=0)``. Tables without a suitable column are
written in hidden buckets of their keys as soon as their size asks for more than one.
"""

from __future__ import annotations

from dataclasses import replace

from tidemark.operators.merge import MergeSpec

# M1, M2: a day's snapshot replaces an earlier one of the same day.
ORG_SNAPSHOT = MergeSpec(keys=("org_id", "dt"), partition_by=("dt",))
REPO_SNAPSHOT = MergeSpec(keys=("org_id", "repo_id", "dt"), partition_by=("dt",))

# M3: only a later week replaces a contributor; a change within the week does not.
CONTRIBUTORS = MergeSpec(
    keys=("org_id", "repo_id", "user_id"),
    update_when=lambda t, s: t("last_week") < s("last_week"),
    partition_by=("repo_id",),
)

# M4: the newest version of a pull wins.
PULLS = MergeSpec(
    keys=("repo_id", "pull_id"),
    update_when=lambda t, s: s("time.updated") > t("time.updated"),
    partition_by=("repo_id",),
)

# M4 for tables with hot repositories: a block of ids follows from the id, so that it
# changes nothing about which rows match, but a merge rewrites only blocks with changes.
PULLS_IN_BLOCKS = replace(
    PULLS, keys=("repo_id", "pull_id", "pull_block"), partition_by=("repo_id", "pull_block")
)

# M5: changed lists replace; what the source no longer has is marked, not removed.
EXPECTATIONS = MergeSpec(
    keys=("expectation_name",),
    update_when=lambda t, s: (t("data_sources") != s("data_sources"))
    | (t("data_quality_issues") != s("data_quality_issues")),
    by_source_when=lambda t: ~t("deprecated"),
    by_source_set={"deprecated": True},
    buckets=0,
)

# M6: a renamed user is overwritten.
USERS = MergeSpec(keys=("user_id",), update_when=lambda t, s: t("user_name") != s("user_name"), buckets=0)
