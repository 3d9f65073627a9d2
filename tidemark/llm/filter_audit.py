"""What each of several filters removes, in every order in which they could be applied.

Documents are judged once by all filters, and counted by the set of filters they fail (a mask of
bits). For an order of filters, a document goes at the step of the first filter it fails: the
minimum, over the filters in its mask, of the filter's position. So the removal steps of all
masks in all orders are one min-plus product, of the masks (0 where failed, infinite where not)
with the positions (the inverse permutations of the orders). The counts are then scattered by
step.

Only masks are computed on texts, in built-in expressions. What is shuffled are rows of some
60 bytes (the text's SHA-256, id, part, mask), combined first: by id and text, so that repeated rows
and common texts without ids meet as one row each; documents are joined to the first of their text
by text and id together, so that a very common text is spread by id. The audit itself sees at most
2^filters rows of a part.

Defined results: NULL texts count as empty; an empty text has no words and fails filter A alone of A
to D; a document repeats (filter E) if its text, as a whole and case-sensitive, is that of a smaller
id anywhere in the table, so that rows without id, and rows that repeat an id with the same text,
do not repeat on that account; a NULL part counts as the empty string; a document is good or
toxic if any label of its id says so, and rows without id have no labels; an empty table gives no
rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, query, stage, table, text_or_empty

#: Filters by letter, E being repetition.
FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Rows without id are dealt to so many joins with the labels, of which they have none.
SALTS = 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that look at one text alone."""
    # Splitting leaves an empty piece at a blank end of the text.
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size("_words")
    return {
        "_words": words,
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct("_words")) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, key, mask, n): documents by id, text and the filters that the text fails."""
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col(id_col).alias("id"), part, text_or_empty(text_col).alias("text"))
    failing = text_failures(F.col("text"))
    rows = rows.withColumn("_words", failing.pop("_words"))
    bits = sum(F.when(failing[f], 1 << FILTERS.index(f)).otherwise(0) for f in failing)
    key = F.unhex(F.sha2(F.col("text"), 256))
    return rows.select("id", "part", key.alias("key"), bits.alias("mask")).groupBy("id", "part", "key", "mask").agg(F.count("*").alias("n"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds the bit of filter E: the text is that of a smaller id."""
    first = rows.where("id is not null").groupBy("key").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    joined = rows.join(first, ["key", "id"], "left")
    repeats = F.col("id").isNotNull() & F.col("first").isNull()
    bit = F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)
    return joined.withColumn("mask", F.col("mask") + bit).drop("first")


def with_marks(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` and ``toxic``, whether a label of the id says so."""
    marks = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        .withColumn("salt", F.lit(0))
    )
    salt = F.when(F.col("id").isNull(), F.pmod(F.hash("key"), F.lit(SALTS))).otherwise(0)
    joined = rows.withColumn("salt", salt).join(marks, ["id", "salt"], "left").drop("salt")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def mask_counts(rows: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): at most 2^filters rows a part."""
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, positions): row r of the second has the step, from 0, of each filter in order r."""
    order = np.array(list(permutations(range(filters))))
    return order, order.argsort(axis=1)


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """(masks, orders): the step at which documents of a mask go; the number of filters if never.

    A min-plus product; the clip stands for infinity.
    """
    filters = positions.shape[1]
    out = np.full((len(masks), len(positions)), filters, positions.dtype)
    for f in range(filters):
        cost = np.where(masks >> f & 1, 0, filters)
        np.minimum(out, np.minimum(cost[:, None] + positions[:, f], filters), out=out)
    return out


def audit(masks: np.ndarray, weights: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Counts of every order and step, (orders, filters) each.

    ``weights`` has a row each for documents, good ones and toxic ones, by mask.
    """
    order, positions = orders(filters)
    step = removal_steps(masks, positions)
    lost = np.zeros((len(weights), len(order), filters + 1), np.int64)
    for k, w in enumerate(weights):
        np.add.at(lost[k], (np.arange(len(order))[None, :], step), w[:, None])
    removed = lost[0][:, :filters]
    fails = masks[:, None] >> np.arange(filters) & 1
    failing = (fails * weights[0][:, None]).sum(axis=0)
    alone = np.array([weights[0][masks == 1 << f].sum() for f in range(filters)])
    by_filter = np.zeros(filters, np.int64)
    np.add.at(by_filter, order, removed)
    return {
        "kept": weights[0].sum() - removed.cumsum(axis=1),
        "removed": removed,
        # Who fails this filter and does not go here has gone before.
        "redundant": failing[order] - removed,
        "unique_fails": alone[order],
        "good_lost": lost[1][:, :filters],
        "toxic_lost": lost[2][:, :filters],
        "shapley": by_filter[order],
    }


def audit_parts(counts: DataFrame, letters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order and step, from ``mask_counts``."""
    names = ["".join(letters[f] for f in o) for o in orders(len(letters))[0]]

    def of_part(rows: pa.Table) -> pa.Table:
        column = {c: rows.column(c).to_numpy() for c in ("mask", "n", "good", "toxic")}
        made = audit(column["mask"].astype(np.int64), np.stack([column[c] for c in ("n", "good", "toxic")]), len(letters))
        k = len(names) * len(letters)
        out = {
            "part": pa.array([rows.column("part")[0].as_py()] * k),
            "filter_order": pa.array(np.repeat(names, len(letters)).tolist()),
            "step": pa.array(np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(names))),
        }
        return pa.table(out | {c: pa.array(made[c].reshape(-1).astype(np.int64)) for c in COUNTS})

    ddl = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return counts.groupBy("part").applyInArrow(of_part, ddl)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of filters A to E over documents by part."""
    # Read twice below, and dear to compute.
    rows = stage(judged(docs, id_col, text_col, part_col), "filter-masks")
    return audit_parts(mask_counts(with_marks(with_repeats(rows), labels, id_col)))


SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda w: w <> '') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(words) < {LEAST_WORDS} AS fails_a,
    100 * len(list_distinct(words)) < 50 * len(words) AS fails_b,
    100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS fails_c,
    regexp_matches(text, '[#$%&*|]') AS fails_d,
    coalesce(doc_id > first_id, false) AS fails_e
  FROM texts JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
fails AS (
  SELECT part, good, toxic, count(*) AS n,
    concat(if(fails_a, 'A', ''), if(fails_b, 'B', ''), if(fails_c, 'C', ''), if(fails_d, 'D', ''), if(fails_e, 'E', '')) AS failed
  FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
sequences AS (
  SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f FROM sequences, unnest(range(1, 6)) AS s(step)),
gone AS (
  SELECT filter_order, failed, part, good, toxic, n,
    list_min(list_transform(string_split(failed, ''), lambda x: CASE WHEN x = '' THEN 9 ELSE instr(filter_order, x) END)) AS leaves
  FROM fails, sequences),
counted AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (leaves > step) AS kept, sum(n) FILTER (leaves = step) AS removed,
    sum(n) FILTER (leaves < step AND contains(failed, f)) AS redundant, sum(n) FILTER (failed = f) AS unique_fails,
    sum(n) FILTER (leaves = step AND good) AS good_lost, sum(n) FILTER (leaves = step AND toxic) AS toxic_lost
  FROM gone JOIN steps USING (filter_order) GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTS[:-1])},
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM counted
"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
