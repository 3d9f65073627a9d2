"""Benchmark passages in documents, found by their templates.

Numbers, names and units become typed placeholders, so that a question with other numbers or
names in it has the same template. A capitalised word that opens a sentence may be a name or not,
and a text in one case shows no names; so every window has three forms: names inside sentences
only, all capitalised words as names, and no names (upper and lower case alike). Windows of five
template words are hashed in their different forms and joined with those of all benchmark items; a
document holds an item if, within a stretch of about the item's length, it has at least 0.8 of the
item's windows in one of the forms. For these the slots are compared: an
item's value must stand for one value of the document throughout (the same value in a copy, any
other in a re-parameterised question); the share of such values is the consistency, at least 0.9.

Hits are judged by diagonal (place in the document minus place in the item). A diagonal that
covers the item by itself is judged with its own words. For copies with words put in or left out,
the diagonals of a stretch add up: each window is taken from the diagonal with most windows, then
with most equal words, so that an item of a repeating shape is not compared one repeat off.

Only DataFrame functions are used. Documents are not shuffled: their windows probe the item
windows, which are broadcast if they are measured to fit and joined by hash otherwise; only hits
are grouped, and a group (one document, one item, one diagonal or stretch) has at most as many
rows as the item has windows, after a first aggregate.

Defined results: NULL and empty texts hold nothing and are never found; items with two to four
words are searched for as one window of that length; windows with fewer than two words besides
placeholders are not used, but for items that have no other, where names count as words; items of
which no window has two words besides numbers and units are not searched for; documents without
id are told apart by their texts; repeated rows give one row; items that repeat an id are
different items of one id; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, stage, table
from tidemark.operators.sizing import fits_broadcast

WINDOW = 5
COVERAGE = 0.8
CONSISTENCY = 0.9
LITERALS = 2
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
UNITS = (
    "mm|cm|dm|km|m|mi|miles?|ft|feet|foot|inch(?:es)?|yd|yards?|mg|kg|g|grams?|kilograms?|lbs?|oz|ounces?|pounds?|tons?|"
    "ml|cl|l|lit(?:er|re)s?|gal|gallons?|s|sec|seconds?|min|minutes?|h|hr|hrs|hours?|days?|weeks?|months?|years?|"
    "meters?|metres?|kilomet(?:er|re)s?|centimet(?:er|re)s?|km/h|mph|kmh|percent|dollars?|cents?|euros?|degrees?|w|kw|kwh|v|hz"
)


#: What stands for a name: inside a sentence only, or any capitalised word, or nothing.
NAMES = (r"\p{Lu}(?<=[^.!?\s]\s.)[\p{L}\p{M}'-]*+", r"\p{Lu}(?<![\p{L}\p{M}\p{N}'-].)[\p{L}\p{M}'-]*+", None)


def placeholders(text: Column, names: str | None = NAMES[0]) -> Column:
    """Names, numbers, and units behind numbers as placeholders; words stay words."""
    named = F.regexp_replace(text, names, NAME) if names else text
    unit = rf"(?i:{UNITS})(?![\p{{L}}\p{{N}}])"
    numbered = F.regexp_replace(named, rf"[0-9](?<![\p{{L}}\p{{N}}].)[0-9.,:/]*+(?:%|{unit})?", NUMBER)
    return F.when(F.contains(numbered, F.lit(NUMBER)), F.regexp_replace(numbered, rf"(?<={NUMBER}\s){unit}", UNIT)).otherwise(numbered)


def words(text: Column) -> Column:
    """Lower-cased words without ASCII punctuation."""
    plain = F.regexp_replace(F.lower(text), r"\p{Punct}++", "")
    # Single spaces, which are most, stay as they are and need no replacement.
    return F.split(F.trim(F.regexp_replace(plain, r"[\x00\s](?<! (?![\x00\s]))[\x00\s]*+", " ")), " ")


def _forms(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per place of a text, with its words and their forms."""
    forms = [words(placeholders(F.col("text"), names)).alias(f"form{i}") for i, names in enumerate(NAMES)]
    worded = rows.select(*keep, words(F.col("text")).alias("plain"), *forms)
    # Every text has a word, if an empty one. Without "outer", Spark infers a filter that cuts all texts once more.
    return worded.select("*", F.posexplode_outer("plain").alias("at", "word"))


def _windows(rows: DataFrame, *keep: str, lengths: tuple[int, ...] = ()) -> DataFrame:
    """One row per place and different form of a window of five words, or of the ``lengths`` too: its hash, place and words."""
    # No lambdas here: they would break the generated code and copy the text's arrays for every place.
    # Nor array_distinct, which makes a set for every place.
    hashes, different = [], []
    for length in (WINDOW, *lengths):
        fits = F.col("at") <= F.size("plain") - length
        made = [f"hash{length}_{i}" for i in range(len(NAMES))]
        for i, name in enumerate(made):
            hashes.append(F.when(fits, F.xxhash64(*[F.get(f"form{i}", F.col("at") + k) for k in range(length)])).alias(name))
            others = [F.col(name) != F.col(other) for other in made[:i]]
            different.append(F.when(reduce(and_, others), F.col(name)) if others else F.col(name))
    hashed = _forms(rows, *keep).select(*keep, "plain", "at", *hashes)
    return hashed.select(*keep, "plain", "at", F.explode(F.array(*different)).alias("hash")).where(F.col("hash").isNotNull())


def _slice(column: str) -> Column:
    return F.slice(F.col(column), F.col("at") + 1, F.col("length"))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(hash, length, item, item_key, item_at, item_words, slots, n_windows) of all items."""
    items = benchmark.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    keyed = items.withColumn("item_key", F.xxhash64("text"))
    marks = F.array(*[F.lit(m) for m in (NAME, NUMBER, UNIT)])
    is_mark = lambda x: F.array_contains(marks, x)
    forms = [f"form{i}" for i in range(len(NAMES))]
    cut = _forms(keyed, "item", "item_key").withColumn("length", F.least(F.lit(WINDOW), F.size("plain")))
    cut = cut.where(F.col("at") <= F.size("plain") - F.col("length"))
    usable = [F.size(F.filter(_slice(f), lambda x: ~is_mark(x))) >= LITERALS for f in forms]
    hashes = []
    for f, use in zip(forms, usable, strict=True):
        by_length = [F.xxhash64(*[F.get(f, F.col("at") + k) for k in range(n)]) for n in range(1, WINDOW + 1)]
        hashes.append(F.when(use, F.element_at(F.array(*by_length), F.col("length"))))
    # Slots: 2 where a placeholder is sure, 1 where a word that opens a sentence may be a name.
    slots = F.zip_with(_slice(forms[0]), _slice(forms[1]), lambda x, y: F.when(is_mark(x), 2).when(is_mark(y), 1).otherwise(0))
    cut = cut.select(
        "item", "item_key", "length", F.col("at").alias("item_at"), _slice("plain").alias("item_words"), slots.alias("slots"),
        usable[0].alias("template"), F.array_distinct(F.array_compact(F.array(*hashes))).alias("hashes"),
    )
    # Items without a usable template are searched for by their words.
    own = Window.partitionBy("item", "item_key")
    cut = cut.withColumn("any", F.max("template").over(own)).where((F.col("template") | ~F.col("any")) & (F.size("hashes") > 0))
    cut = cut.withColumn("n_windows", F.count("*").over(own))
    return cut.select(F.explode("hashes").alias("hash"), "length", "item", "item_key", "item_at", "item_words", "slots", "n_windows")


def _judged(found: DataFrame) -> DataFrame:
    """Coverage, consistency of the slots and exactness of windows ``w`` of an item."""
    zipped = F.flatten(F.transform("w", lambda w: F.arrays_zip(w["item_words"].alias("a"), w["doc_words"].alias("b"), w["slots"].alias("s"))))

    def of(slot):
        return F.array_distinct(F.transform(F.filter(zipped, lambda x: x["s"] == slot), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))))

    # An opening word that stays the same throughout is no evidence for names.
    other = F.filter("loose", lambda p: (p["a"] != p["b"]) | F.exists(F.array_union("sure", "loose"), lambda q: (q["a"] == p["a"]) & (q["b"] != p["b"])))
    found = found.withColumn("sure", of(2)).withColumn("loose", of(1)).withColumn("pairs", F.array_union("sure", other))
    values = F.array_distinct(F.transform("pairs", lambda p: p["a"]))
    return found.select(
        "doc", "text_hash", "item",
        (F.size("w") / F.col("n_windows")).alias("coverage"),
        F.forall("w", lambda w: w["item_words"] == w["doc_words"]).alias("exact"),
        F.when(F.size("pairs") > 0, F.size(values) / F.size("pairs")).otherwise(F.lit(1.0)).alias("consistency"),
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
    consistency: float = CONSISTENCY,
) -> DataFrame:
    """(doc, text_hash, item, coverage, consistency, exact): items that documents hold."""
    items = item_windows(benchmark, item_id_col, item_text_col)
    probe = F.broadcast(items) if fits_broadcast(items) else items
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("text_hash", F.xxhash64("text"))
    # At most WINDOW - 2 lengths of short items.
    short = tuple(sorted(r[0] for r in items.where(F.col("length") < WINDOW).select("length").distinct().collect()))
    hits = _windows(keyed, "doc", "text_hash", lengths=short).join(probe, "hash")
    found = ["doc", "text_hash", "item", "item_key"]
    # Exploded, so that hits and not their texts' arrays reach the aggregate.
    hit = F.struct("item_at", "item_words", "slots", _slice("plain").alias("doc_words"))
    hits = hits.select(*found, "n_windows", (F.col("at") - F.col("item_at")).alias("diagonal"), F.explode(F.array(hit)).alias("w"))
    # A window has one place on a diagonal; repeated rows and several equal forms give it again.
    diagonals = hits.groupBy(*found, "diagonal").agg(F.min("n_windows").alias("n_windows"), F.collect_set("w").alias("w"))
    same = F.size(F.filter("w", lambda w: w["item_words"] == w["doc_words"]))
    diagonals = diagonals.withColumn("support", F.struct(F.size("w").alias("n"), same.alias("same"), (-F.col("diagonal")).alias("first")))
    straight = diagonals.where(F.col("support.n") >= coverage * F.col("n_windows")).select(*found, "n_windows", "w")
    # Stretches of the item's length, each diagonal in the two that overlap it.
    stretch = F.floor(F.col("diagonal") / F.col("n_windows"))
    group = [*found, "stretch"]
    spread = diagonals.select(*found, "n_windows", "support", "w", F.explode(F.array(stretch, stretch + 1)).alias("stretch"))
    once = (
        spread.select(*group, "n_windows", "support", F.explode("w").alias("w"))
        .groupBy(*group, "w.item_at")
        .agg(F.min("n_windows").alias("n_windows"), F.max("support")["first"].alias("diagonal"), F.max_by("w", "support").alias("w"))
    )
    runs = once.groupBy(*group, "diagonal").agg(F.min("n_windows").alias("n_windows"), F.collect_list("w").alias("w"))
    runs = runs.groupBy(*group).agg(F.min("n_windows").alias("n_windows"), F.collect_list("w").alias("runs"))
    # A gap loses at most WINDOW windows, and what fills it from another diagonal may be another repeat: judged with and without.
    ways = F.array(F.flatten("runs"), F.flatten(F.filter("runs", lambda r: F.size(r) > WINDOW)))
    bent = runs.select(*found, "n_windows", F.explode(ways).alias("w")).where(F.size("w") >= coverage * F.col("n_windows"))
    judged = _judged(straight.unionByName(bent))
    best = judged.where(F.col("consistency") >= consistency).groupBy("doc", "text_hash", "item")
    return best.agg(F.max("coverage").alias("coverage"), F.max("consistency").alias("consistency"), F.max("exact").alias("exact"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    found = stage(find_leaks(docs, benchmark, id_col, text_col).select("doc", "text_hash").distinct(), "leaks").alias("f")
    text_hash = F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit("")))
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("f.doc")) & (text_hash == F.col("f.text_hash"))
    if fits_broadcast(found):
        found = F.broadcast(found)
    return docs.alias("d").join(found, same, "left_anti")


@query("op9_template_leaks")
def op9_template_leaks(spark, sf_dir):
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.round("coverage", 6).alias("coverage"), "consistency", "exact"
    )
