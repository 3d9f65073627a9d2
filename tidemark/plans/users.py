"""The users dimension: members of the latest organization snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.policies import USERS
from tidemark.plans.derived import DerivedTable
from tidemark.sources import catalog


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Rows of the table's latest day; an organization not loaded that day drops out."""
    return snapshots.filter(F.col("dt") == snapshots.select(F.max("dt")).scalar())


def current_users(snapshots: DataFrame) -> DataFrame:
    """(user_id, user_name) of all members of the latest day, one row per user.

    A member of several organizations appears once; should the names differ, the
    greatest is taken, so that reruns agree.
    """
    members = latest_snapshot(snapshots).select(F.explode("members").alias("user"))
    return members.groupBy(F.col("user.id").alias("user_id")).agg(F.max("user.name").alias("user_name"))


def users_table(name: str, orgs_table: str) -> DerivedTable:
    return DerivedTable(name, lambda spark: current_users(catalog.read(spark, orgs_table)), USERS)
