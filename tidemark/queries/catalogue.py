"""Expectation catalogue, JSON and URL queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.nested import pack
from tidemark.functions.text import pick_url, schema_name, url_map
from tidemark.operators.merge import ACTION, merge_plan
from tidemark.operators.policies import EXPECTATIONS
from tidemark.operators.select import pad_union
from tidemark.plans.expectations import core_expectations, core_of_documents, legacy_expectations, stored_documents, with_legacy
from tidemark.queries.registry import query, scratch_database, spread_table, table
from tidemark.session import scratch_path
from tidemark.sources import catalog, landed
from tidemark.sources.staging import stage

SOURCES = ["Snowflake", "pandas", "BigQuery", "Spark"]
ISSUES = ["Volume", "schema", "Uniqueness"]


def schema_docs(spark, sf_dir, keep="true", size=None):
    """One schema document per part, below a path that carries its name."""
    rows = spread_table(spark, sf_dir, "part").filter(keep)
    size = F.col("p_size") if size is None else size
    names = lambda values, n: F.slice(F.array(*[F.lit(v) for v in values]), 1, n)
    metadata = pack(
        supported_data_sources=pack(const=names(SOURCES, (size % 4 + 1).cast("int"))),
        data_quality_issues=pack(const=F.when(size % 7 != 0, names(ISSUES, (size % 3 + 1).cast("int")))),
    )
    doc = pack(
        title=F.concat(F.lit("Expect "), "p_name", F.lit(" "), F.col("p_partkey").cast("string")),
        properties=pack(metadata=pack(properties=metadata)),
    )
    kind = F.when(F.col("p_partkey") % 6 == 0, F.lit("extra/")).otherwise(F.lit("core/"))
    file = F.concat(kind, F.lit("schemas/Expect"), F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit(".json"))
    return rows.select("p_partkey", file.alias("path"), F.to_json(doc).alias("value"))


CORE = """
    SELECT lower(replace('Expect ' || p_name || ' ' || CAST(p_partkey AS VARCHAR), ' ', '_')) AS expectation_name,
           array_to_string(list_sort((['snowflake', 'pandas', 'bigquery', 'spark'])[1:({size}) % 4 + 1]), ',') AS data_sources,
           CASE WHEN ({size}) % 7 <> 0
                THEN array_to_string(list_sort((['volume', 'schema', 'uniqueness'])[1:({size}) % 3 + 1]), ',')
           END AS data_quality_issues,
           false AS deprecated
    FROM part WHERE {where}
"""
LEGACY_NAME = (
    "CASE WHEN p_partkey % 3 = 0 THEN lower(replace('Expect ' || p_name || ' ' || CAST(p_partkey AS VARCHAR), ' ', '_'))"
    " ELSE 'legacy_' || CAST(p_partkey AS VARCHAR) END"
)
LEGACY = f"""
    SELECT {LEGACY_NAME} AS expectation_name,
           array_to_string(list_sort(list_filter([
               CASE WHEN p_size % 2 = 0 THEN 'pandas' END, CASE WHEN p_size % 3 = 0 THEN 'spark' END,
               CASE WHEN p_size % 5 <> 0 THEN 'sql' END, CASE WHEN p_size % 7 = 0 THEN 'sql' END
           ], lambda x: x IS NOT NULL)), ',') AS data_sources,
           CAST(NULL AS VARCHAR) AS data_quality_issues, true AS deprecated
    FROM part
"""


def flat(df):
    return df.withColumns(
        {
            "data_sources": F.array_join(F.array_sort("data_sources"), ","),
            "data_quality_issues": F.array_join("data_quality_issues", ","),
        }
    )


@query(CORE.format(size="p_size", where="p_partkey % 6 <> 0"))
def expectations_core(spark, sf_dir):
    """Core documents by path prefix, names and lists canonical."""
    docs = schema_docs(spark, sf_dir).filter(F.startswith("path", F.lit("core/schemas/Expect")))
    return flat(core_expectations(docs))


@query(
    """
    SELECT p_partkey,
           'Expect' || upper(p_name[1]) || split_part(p_name, ' ', 1)[2:]
                    || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS name
    FROM part
    """
)
def schema_names(spark, sf_dir):
    """The name in each document's path."""
    return schema_docs(spark, sf_dir).select("p_partkey", schema_name(F.col("path")).alias("name"))


def legacy_docs(spark, sf_dir):
    """Legacy documents: objects keyed by name. A third of the names are core names."""
    core_name = F.lower(
        F.replace(F.concat(F.lit("Expect "), "p_name", F.lit(" "), F.col("p_partkey").cast("string")), F.lit(" "), F.lit("_"))
    )
    old_name = F.concat(F.lit("legacy_"), F.col("p_partkey").cast("string"))
    engines = pack(
        PandasExecutionEngine=F.col("p_size") % 2 == 0,
        SparkDFExecutionEngine=F.col("p_size") % 3 == 0,
        SqlAlchemyExecutionEngine=F.col("p_size") % 5 != 0,
        TrinoExecutionEngine=F.col("p_size") % 7 == 0,
    )
    name = F.when(F.col("p_partkey") % 3 == 0, core_name).otherwise(old_name)
    return spread_table(spark, sf_dir, "part").select(
        F.to_json(F.create_map(name, pack(execution_engines=engines))).alias("value")
    )


@query(LEGACY)
def expectations_legacy(spark, sf_dir):
    """Engines that are on, as source classes."""
    return flat(legacy_expectations(legacy_docs(spark, sf_dir)))


@query(
    f"""
    WITH core AS ({CORE.format(size="p_size", where="true")}), legacy AS ({LEGACY})
    SELECT * FROM legacy WHERE expectation_name NOT IN (SELECT expectation_name FROM core)
    UNION ALL SELECT * FROM core ORDER BY deprecated, expectation_name
    """
)
def expectations_with_legacy(spark, sf_dir):
    """The core set plus legacy names it lacks, sorted."""
    core = core_expectations(schema_docs(spark, sf_dir))
    return flat(with_legacy(core, legacy_expectations(legacy_docs(spark, sf_dir))))


@query(
    f"""
    WITH t AS (SELECT * REPLACE (expectation_name LIKE '%ring%' AS deprecated)
               FROM ({CORE.format(size="p_size", where="p_partkey % 8 <> 0")})),
    s AS ({CORE.format(size="p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END", where="p_partkey % 9 <> 0")}),
    decided AS (
        SELECT t.expectation_name AS tn, s.expectation_name AS sn,
               CASE WHEN t.expectation_name IS NULL THEN 'insert'
                    WHEN s.expectation_name IS NULL THEN CASE WHEN t.deprecated THEN 'keep' ELSE 'soft_delete' END
                    WHEN coalesce(t.data_sources <> s.data_sources OR t.data_quality_issues <> s.data_quality_issues, false)
                    THEN 'update' ELSE 'keep' END AS action,
               t.data_sources AS ts, s.data_sources AS ss, t.data_quality_issues AS ti, s.data_quality_issues AS si,
               t.deprecated AS td, s.deprecated AS sd
        FROM t FULL OUTER JOIN s ON t.expectation_name = s.expectation_name
    )
    SELECT coalesce(tn, sn) AS expectation_name,
           CASE WHEN action IN ('insert', 'update') THEN ss ELSE ts END AS data_sources,
           CASE WHEN action IN ('insert', 'update') THEN si ELSE ti END AS data_quality_issues,
           CASE WHEN action IN ('insert', 'update') THEN sd WHEN action = 'soft_delete' THEN true ELSE td END AS deprecated,
           action
    FROM decided
    """
)
def expectations_merge(spark, sf_dir):
    """M5: changed lists replace, absent ones are marked deprecated, some return."""
    stored = core_expectations(schema_docs(spark, sf_dir, "p_partkey % 8 <> 0")).withColumn(
        "deprecated", F.contains("expectation_name", F.lit("ring"))
    )
    target = stage(stored, "expectations")
    changed = F.col("p_size") + F.when(F.col("p_partkey") % 5 == 0, 1).otherwise(0)
    source = stage(core_expectations(schema_docs(spark, sf_dir, "p_partkey % 9 <> 0", changed)), "expectations")
    return flat(merge_plan(target, source, EXPECTATIONS).withColumnRenamed(ACTION, "action"))


@query(
    """
    SELECT event_id, k, k AS k_declared, CAST(NULL AS VARCHAR) AS missing
    FROM (SELECT event_id, CASE WHEN json_valid(props) THEN TRY_CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events)
    """
)
def json_extract(spark, sf_dir):
    """Fields by path from documents, and by declared schema."""
    fields = landed.pick_fields(F.col("props"), {"k": ("$.k", "bigint"), "missing": ("$.a.b", "string")})
    declared = landed.parse_record(F.col("props"), "k bigint")["k"].alias("k_declared")
    return table(spark, sf_dir, "events").select("event_id", *fields, declared)


@query(
    """
    SELECT event_id, ts, event_type FROM events
    """
)
def landed_pages(spark, sf_dir):
    """Pages of up to 100 records, landed as lines and read back as records.

    A page is a block of 100 keys, so its list is bounded.
    """
    event = pack(id=F.col("event_id"), kind=F.col("event_type"), at=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    pages = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / 100).alias("page"))
        .agg(F.collect_set(event).alias("records"))
        .select(F.to_json("records").alias("value"))
    )
    path = scratch_path(spark, "pages")
    pages.write.text(path)
    read = landed.read_pages(spark, path, "array<struct<id: bigint, kind: string, at: string>>", one_per_file=False)
    return read.select(
        F.col("record.id").alias("event_id"),
        F.col("record.at").try_cast("timestamp_ntz").alias("ts"),
        F.col("record.kind").alias("event_type"),
    )


@query(
    """
    SELECT p_partkey AS id, p_name AS name, CAST(p_size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS nation FROM part
    UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier
    """
)
def inferred_records(spark, sf_dir):
    """S3: documents of two shapes, read with the schema inferred over all of them."""
    part = pack(id=F.col("p_partkey"), name=F.col("p_name"), size=F.col("p_size"))
    supplier = pack(id=F.col("s_suppkey"), name=F.col("s_name"), nation=F.col("s_nationkey").cast("string"))
    parts = table(spark, sf_dir, "part").select(F.to_json(part).alias("value"))
    suppliers = table(spark, sf_dir, "supplier").select(F.to_json(supplier).alias("value"))
    return landed.infer_records(parts.unionByName(suppliers))


@query("SELECT p_partkey AS VOID_id, p_name AS AVOID, CAST(NULL AS VARCHAR) AS EMPTY, p_size % 2 = 0 AS OBJECT_flag FROM part")
def inferred_names(spark, sf_dir):
    """S3: fields named like type words keep their names; one that is always null is a string."""
    doc = F.concat(
        F.lit('{"VOID_id": '), F.col("p_partkey").cast("string"), F.lit(', "EMPTY": null, "OBJECT_flag": '),
        (F.col("p_size") % 2 == 0).cast("string"), F.lit(', "AVOID": '), F.to_json(F.array("p_name")), F.lit("}"),
    )
    docs = table(spark, sf_dir, "part").select(F.replace(F.replace(doc, F.lit(': ["'), F.lit(': "')), F.lit('"]}'), F.lit('"}')).alias("value"))
    return landed.infer_records(docs).select(F.col("VOID_id").cast("bigint").alias("VOID_id"), "AVOID", "EMPTY", "OBJECT_flag")


@query(
    """
    SELECT c_mktsegment AS folder, count(*) AS customers, 'folder' AS origin FROM customer GROUP BY 1
    UNION ALL SELECT 'BUILDING', count(*), 'fallback' FROM customer WHERE c_mktsegment = 'BUILDING'
    """
)
def catalogued_files(spark, sf_dir):
    """Files found by a prefix below a root with a blank in its name, and read as a fallback."""
    root = scratch_path(spark, "landed files")
    body = F.to_json(F.struct(F.col("c_custkey").alias("id"))).alias("value")
    table(spark, sf_dir, "customer").select(body, F.concat(F.lit("by "), "c_mktsegment").alias("segment")).write.partitionBy("segment").text(root)
    lines = F.size(F.split(F.rtrim(F.regexp_replace("value", "\n+$", "")), "\n"))
    files = landed.file_catalogue(spark, root, "segment=by ").select(
        F.regexp_replace(F.url_decode(F.regexp_extract("path", "segment=([^/]*)/", 1)), "by(?: |%20)", "").alias("folder"), lines.alias("n")
    )
    found = files.groupBy("folder").agg(F.sum("n").alias("customers")).withColumn("origin", F.lit("folder"))
    fallback = landed.read_with_fallback(spark, f"{root}/nothing", f"{root}/segment=by BUILDING")
    counted = fallback.agg(F.sum(lines).alias("customers")).select(F.lit("BUILDING").alias("folder"), "customers", F.lit("fallback").alias("origin"))
    return found.unionByName(counted)


def mixed_docs(spark, sf_dir):
    """Event documents whose fields vary with the event type."""
    inner = F.concat(F.lit('{"'), "event_type", F.lit('_id": 1, "props": '), "props", F.lit("}"))
    doc = F.concat(F.lit('{"'), "event_type", F.lit('": true, "properties": '), inner, F.lit("}"))
    return table(spark, sf_dir, "events").select(doc.alias("value"))


@query("SELECT DISTINCT event_type AS key, 'top' AS level FROM events UNION SELECT 'properties', 'top' UNION "
       "SELECT DISTINCT event_type || '_id', 'inner' FROM events UNION SELECT 'props', 'inner'")
def json_keys(spark, sf_dir):
    """Distinct field names, at the top and inside one object."""
    docs = mixed_docs(spark, sf_dir)
    top = landed.top_level_keys(docs, "value").withColumn("level", F.lit("top"))
    return top.unionByName(landed.property_keys(docs, "value").withColumn("level", F.lit("inner")))


@query(
    """
    SELECT p_partkey AS id, p_name AS name, p_size AS size, CAST(NULL AS DOUBLE) AS balance FROM part
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """
)
def padded_records(spark, sf_dir):
    """Records with differing fields over the union of them, in sorted order."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return pad_union([parts, suppliers])


@query(
    """
    SELECT page_id, 'html,pulls,url' AS url_names, url || '/pulls' AS pulls_url,
           url || '/pulls{/number}' AS pulls_template, split_part(url, '{', 1) AS page_url
    FROM pages
    """
)
def url_parts(spark, sf_dir):
    """A record's URLs by name, with and without parameters."""
    fields = F.create_map(
        F.lit("url"), F.col("url"),
        F.lit("html_url"), F.concat("url", F.lit("{?ref}")),
        F.lit("pulls_url"), F.concat("url", F.lit("/pulls{/number}")),
        F.lit("mirror_url"), F.lit(None).cast("string"),
        F.lit("name"), F.lit("page"),
    )
    records = table(spark, sf_dir, "pages").select("page_id", url_map(fields).alias("urls"))
    return records.select(
        "page_id",
        F.array_join(F.array_sort(F.map_keys("urls")), ",").alias("url_names"),
        pick_url(F.col("urls"), "pulls").alias("pulls_url"),
        pick_url(F.col("urls"), "pulls", with_params=True).alias("pulls_template"),
        pick_url(F.col("urls")).alias("page_url"),
    )


def _merged_sql(t: str, s: str) -> str:
    """Policy M5 over two relations of flat expectations, without the actions."""
    return f"""
        SELECT coalesce(t.expectation_name, s.expectation_name) AS expectation_name,
               CASE WHEN new OR changed THEN s.data_sources ELSE t.data_sources END AS data_sources,
               CASE WHEN new OR changed THEN s.data_quality_issues ELSE t.data_quality_issues END AS data_quality_issues,
               CASE WHEN new OR changed THEN s.deprecated WHEN s.expectation_name IS NULL THEN true ELSE t.deprecated END AS deprecated
        FROM (SELECT t, s, t.expectation_name IS NULL AS new,
                     coalesce(t.data_sources <> s.data_sources OR t.data_quality_issues <> s.data_quality_issues, false) AS changed
              FROM {t} AS t FULL OUTER JOIN {s} AS s ON t.expectation_name = s.expectation_name)"""


ROUNDS = (
    ("p_size", "p_partkey % 8 <> 0"),
    ("p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END", "p_partkey % 9 <> 0"),
    ("p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 18 = 0 THEN 1 ELSE 0 END", "p_partkey % 7 <> 0"),
)


@query(
    "WITH "
    + ", ".join(f"s{k} AS ({CORE.format(size=size, where=where)})" for k, (size, where) in enumerate(ROUNDS))
    + f", m1 AS ({_merged_sql('s0', 's1')}), m2 AS ({_merged_sql('m1', 's2')})"
    + " SELECT *, CAST(0 AS BIGINT) AS files_replaced_by_rerun FROM m2"
)
def expectations_kept(spark, sf_dir):
    """M5 on a table in buckets: changes, deletions, returns with and without a change; then the same again.

    Only buckets with a decided change are written; a source that changes nothing writes nothing.
    """
    name, spec = f"{scratch_database(spark)}.expectations", replace(EXPECTATIONS, buckets=8)
    for size, where in ROUNDS:
        catalog.merge_into(core_expectations(schema_docs(spark, sf_dir, where, F.expr(size))), name, spec)
    before = set(catalog.read(spark, name).inputFiles())
    catalog.merge_into(core_expectations(schema_docs(spark, sf_dir, where, F.expr(size))), name, spec)
    stored = catalog.read(spark, name)
    return flat(stored).withColumn("files_replaced_by_rerun", F.lit(len(before ^ set(stored.inputFiles()))).cast("bigint"))


@query(CORE.format(size="p_size", where="p_partkey % 6 <> 0"))
def expectations_stored(spark, sf_dir):
    """S3, F16: core documents from a table that keeps them as variants; the scan reads the paths they need."""
    name = f"{scratch_database(spark)}.documents"
    catalog.create_as(stored_documents(schema_docs(spark, sf_dir)), name)
    docs = catalog.read(spark, name).filter(F.startswith("path", F.lit("core/schemas/Expect")))
    return flat(core_of_documents(docs))


@query("SELECT DISTINCT event_type AS key, 'top' AS level FROM events UNION SELECT 'properties', 'top' UNION "
       "SELECT DISTINCT event_type || '_id', 'inner' FROM events UNION SELECT 'props', 'inner'")
def stored_keys(spark, sf_dir):
    """Distinct field names of documents kept as variants, at the top and inside one object."""
    name = f"{scratch_database(spark)}.documents"
    docs = catalog.create_as(landed.as_documents(mixed_docs(spark, sf_dir)), name)
    top = landed.document_keys(docs).withColumn("level", F.lit("top"))
    return top.unionByName(landed.document_keys(docs, "$.properties").withColumn("level", F.lit("inner")))
