"""Landed JSON: pages, records, file catalogues and files with a fallback."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields read from each kind of landed record.
ORG = "id bigint, public_repos int, owned_private_repos int"
MEMBERS = "array<struct<id: bigint, login: string>>"
REPOS = (
    "array<struct<id: bigint, name: string, private: boolean, fork: boolean, archived: boolean,"
    " pushed_at: string, created_at: string, updated_at: string>>"
)
CONTRIBUTORS = (
    "array<struct<author: struct<id: bigint, login: string>,"
    " weeks: array<struct<w: string, a: string, d: string, c: string>>>>"
)
PULLS = (
    "array<struct<id: string, number: string, title: string, user: struct<id: bigint>,"
    " labels: array<struct<name: string>>, draft: boolean,"
    " created_at: string, updated_at: string, closed_at: string, merged_at: string>>"
)
PULL_DETAIL = ("comments", "review_comments", "commits", "changed_files")
REVIEWS = "array<struct<id: bigint, user: struct<id: bigint>, state: string, submitted_at: string>>"


def read_texts(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed texts as (path, value): one per file, or one per line.

    Lines suit large landings, because a line-delimited file can be split.
    """
    texts = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=one_per_file)
    return texts.select(F.col("_metadata.file_path").alias("path"), "value")


def read_pages(spark: SparkSession, path: str, element: str, one_per_file: bool = True) -> DataFrame:
    """The records of all pages below ``path``, one row per record.

    ``element`` is the DDL of an ``array<struct<…>>``. A page that is a single object
    counts as a list of one.
    """
    return explode_pages(read_texts(spark, path, one_per_file), "value", element)


def explode_pages(pages: DataFrame, column: str, element: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Concatenate pages held in a text column: one row per record, as struct ``record``.

    A page that is not JSON of that shape is an error, as its records would be lost.
    """
    records = required(F.from_json(F.col(column), element), F.col(column), "unreadable page")
    return pages.select(*keep, F.explode(records).alias("record"))


def required(value: Column, text: Column, message: str) -> Column:
    """``value``, or an error naming the start of the text that did not yield one."""
    wrong = F.raise_error(F.concat(F.lit(f"{message}: "), F.coalesce(F.left(text, F.lit(200)), F.lit("NULL"))))
    return F.coalesce(value, wrong)  # which, unlike a CASE, parses the text once


def readable(value: Column, text: Column, message: str) -> Column:
    """``value``, NULL where nothing was landed, or an error where a text did not yield one."""
    nothing = text.isNull() | (F.trim(text) == "null")
    return F.when(~nothing, required(value, text, message))


def parse_record(text: Column, ddl: str) -> Column:
    """One record parsed against its declared fields."""
    return F.from_json(text, ddl)


def whole_number(text: Column, kind: str = "bigint") -> Column:
    """A number given as a number or as text; NULL if it is neither or does not fit ``kind``."""
    return text.try_cast(kind)


def is_unreadable(text: Column, kind: str = "bigint") -> Column:
    """True where there is a value but no number of that kind in it."""
    return text.isNotNull() & whole_number(text, kind).isNull()


def pick_fields(text: Column, fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Fields of records whose shape varies: name → (JSON path, type).

    A field that is missing, or of another type, is NULL.
    """
    return document_fields(F.try_parse_json(text), fields)


def document_fields(doc: Column, fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Fields of a document kept as variant. From a stored table Spark reads only these paths."""
    return [F.try_variant_get(doc, path, kind).alias(name) for name, (path, kind) in fields.items()]


def as_documents(texts: DataFrame, column: str = "value") -> DataFrame:
    """The rows with their text as ``doc``, a variant that is parsed once and stored shredded.

    A text that is no JSON stays under ``unreadable``; ``doc`` is NULL there.
    """
    doc = F.try_parse_json(column)
    others = [c for c in texts.columns if c != column]
    return texts.select(*others, doc.alias("doc"), F.when(doc.isNull(), F.col(column)).alias("unreadable"))


def document_keys(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Distinct field names of documents kept as variant, at the top or of the object at ``path``."""
    whole = F.col("doc") if path is None else F.try_variant_get("doc", path, "variant")
    objects = docs.select(whole.alias("object")).filter(F.startswith(F.schema_of_variant("object"), F.lit("OBJECT<")))
    entries = docs.sparkSession.tvf.variant_explode(F.col("object").outer())
    return objects.lateralJoin(entries).select("key").distinct()


def picked_or_error(doc: Column, fields: Mapping[str, tuple[str, str]], message: str) -> list[Column]:
    """As ``document_fields``, but a field that is there with another type is an error."""
    return [
        _of_its_kind(F.try_variant_get(doc, path, kind), F.try_variant_get(doc, path, "variant"), name, kind, message)
        for name, (path, kind) in fields.items()
    ]


def checked_fields(texts: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], message: str) -> DataFrame:
    """``text`` and its fields as by ``picked_or_error``; each text is parsed once, each path read once.

    Every step is a projection of its own. In one expression over arrays, which Spark does not
    compile, each mention of a field would parse the whole text again.
    """
    parsed = texts.select(F.col(column).alias("text"), F.try_parse_json(column).alias("doc"))
    kinds = {name: kind for name, (_, kind) in fields.items()}
    values = [F.try_variant_get("doc", path, kind).alias(f"value_{name}") for name, (path, kind) in fields.items()]
    found = [F.try_variant_get("doc", path, "variant").alias(f"found_{name}") for name, (path, _) in fields.items()]
    read = parsed.select("text", *values, *found)
    return read.select("text", *[_of_its_kind(F.col(f"value_{n}"), F.col(f"found_{n}"), n, kind, message) for n, kind in kinds.items()])


def _of_its_kind(value: Column, found: Column, name: str, kind: str, message: str) -> Column:
    wrong = found.isNotNull() & ~F.is_variant_null(found) & value.isNull()
    error = F.raise_error(F.concat(F.lit(f"{message} {name}: "), F.left(found.cast("string"), F.lit(200))))
    return F.when(wrong, error.cast(kind)).otherwise(value).alias(name)


def infer_schema(texts: DataFrame, column: str = "value") -> str:
    """DDL of the struct that holds every field of the JSON objects in ``column``.

    The schema is merged by an aggregate over all texts, so only it reaches the driver.
    A field with types that do not agree becomes a variant, one always null a string;
    texts that are not objects are left out.
    """
    doc = F.try_parse_json(column)
    is_object = F.startswith(F.schema_of_variant(doc), F.lit("OBJECT<"))
    kind = texts.filter(is_object).agg(F.schema_of_variant_agg(doc)).first()[0]
    if not kind or not kind.startswith("OBJECT<"):
        raise ValueError("there is no JSON object to infer a schema from")
    return _as_ddl(kind)


def _as_ddl(kind: str) -> str:
    """A variant's schema as DDL. Only type words change, which stand at the start or behind
    ``: `` or ``ARRAY<``; field names stay, those in backticks whatever they hold."""
    parts = re.split(r"(`(?:[^`]|``)*`)", kind)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"(^|: |ARRAY<)OBJECT<" if i == 0 else r"(: |ARRAY<)OBJECT<", r"\1STRUCT<", parts[i])
        parts[i] = re.sub(r"(: |ARRAY<)VOID(?=[,>]|$)", r"\1STRING", parts[i])
    return "".join(parts)


def infer_records(texts: DataFrame, column: str = "value") -> DataFrame:
    """Records of unknown shape, one column per field found in any of them."""
    return texts.select(F.from_json(column, infer_schema(texts, column)).alias("r")).select("r.*")


def top_level_keys(texts: DataFrame, column: str) -> DataFrame:
    """Distinct field names over all documents."""
    return _distinct_keys(texts, F.col(column))


def property_keys(texts: DataFrame, column: str, path: str = "$.properties") -> DataFrame:
    """Distinct field names inside one object of every document."""
    return _distinct_keys(texts, F.get_json_object(F.col(column), path))


def _distinct_keys(texts: DataFrame, doc: Column) -> DataFrame:
    return texts.select(F.explode(F.json_object_keys(doc)).alias("key")).distinct()


def file_catalogue(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Files below ``root`` whose path there starts with ``prefix``, each read whole.

    No such file is an error. The filter on the file path prunes files before reading.
    """
    files = read_texts(spark, root)
    found = files.filter(_plain_path(F.col("path")).startswith(_plain_path(F.lit(_encoded(spark, root, prefix)))))
    if found.isEmpty():
        raise ValueError(f"no file below {root} starts with {prefix}")
    return found


def _encoded(spark: SparkSession, root: str, prefix: str) -> str:
    """A path as Spark reports those of files: qualified and URL-encoded."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{prefix}")
    qualified = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder)
    return qualified.toUri().toString() + ("/" if prefix.endswith("/") or not prefix else "")


def _plain_path(path: Column) -> Column:
    """A local path has one slash or three behind its scheme."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_with_fallback(spark: SparkSession, primary: str, fallback: str) -> DataFrame:
    """The texts of ``primary``, or those of ``fallback`` if none of them is JSON."""
    try:
        texts = read_texts(spark, primary)
        usable = not texts.filter(F.try_parse_json("value").isNotNull()).isEmpty()
    except Exception as error:  # a missing path is Spark's AnalysisException
        if "PATH_NOT_FOUND" not in str(error):
            raise
        usable = False
    return texts if usable else read_texts(spark, fallback)
