"""A catalogue of data-quality expectations: the core set and the legacy set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.nested import engine_classes, sorted_lower, true_keys
from tidemark.functions.text import underscored
from tidemark.operators.select import stack_by_position
from tidemark.sources import landed
from tidemark.sources.staging import stage

TABLE = "expectations"

# Where a schema document keeps its lists.
_CONST = "$.properties.metadata.properties.{}.const"
FIELDS = {
    "title": ("$.title", "string"),
    "data_sources": (_CONST.format("supported_data_sources"), "array<string>"),
    "data_quality_issues": (_CONST.format("data_quality_issues"), "array<string>"),
}
LEGACY = "map<string, struct<execution_engines: map<string, boolean>>>"


def core_expectations(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row per schema document: name normalized, lists lower case and sorted.

    A list that is not one of texts is an error; one that is missing is NULL.
    """
    return _core(landed.checked_fields(docs, column, FIELDS, "unreadable"))


def stored_documents(docs: DataFrame, column: str = "value") -> DataFrame:
    """Schema documents as variants, for a table that is read by path; checked once, as it is made."""
    whole = landed.as_documents(docs, column)
    title, *lists = landed.picked_or_error(F.col("doc"), FIELDS, "unreadable")
    text = F.coalesce(F.to_json("doc"), "unreadable")
    # Conditions that always hold, where nothing raises.
    fine = F.char_length(landed.required(title, text, "no title in document")) >= 0
    for c in lists:
        fine = fine & (F.coalesce(F.array_size(c), F.lit(0)) >= 0)
    return whole.withColumn("doc", F.when(fine, F.col("doc"))).drop("unreadable")


def core_of_documents(docs: DataFrame, column: str = "doc") -> DataFrame:
    """``core_expectations`` of documents kept as variant; only the paths it needs are read."""
    return _core(docs.select(F.lit("stored").alias("text"), *landed.document_fields(F.col(column), FIELDS)))


def _core(picked: DataFrame) -> DataFrame:
    return picked.select(
        underscored(landed.required(F.col("title"), F.col("text"), "no title in document")).alias("expectation_name"),
        sorted_lower(F.col("data_sources")).alias("data_sources"),
        sorted_lower(F.col("data_quality_issues")).alias("data_quality_issues"),
        F.lit(False).alias("deprecated"),
    )


def legacy_expectations(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row per name in the legacy documents, with the classes of its engines.

    A document that cannot be read is an error.
    """
    entries = landed.readable(F.from_json(column, LEGACY), F.col(column), "unreadable legacy document")
    named = docs.select(F.explode(entries).alias("expectation_name", "entry"))
    return named.select(
        "expectation_name",
        engine_classes(true_keys(F.col("entry.execution_engines"))).alias("data_sources"),
        F.lit(None).cast("array<string>").alias("data_quality_issues"),
        F.lit(True).alias("deprecated"),
    )


def with_legacy(core: DataFrame, legacy: DataFrame) -> DataFrame:
    """Legacy names the core set lacks, then the core set; current ones first.

    Both are staged: the core set is read for its names too, and sorting reads all rows twice.
    """
    core, legacy = stage(core, "core"), stage(legacy, "legacy")
    gone = legacy.join(core.select("expectation_name").distinct(), "expectation_name", "left_anti")
    return stack_by_position(gone, core).orderBy("deprecated", "expectation_name")
