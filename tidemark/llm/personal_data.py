"""Personal data: generous candidates, judged by gradient-boosted trees.

Fixed patterns with checks (Luhn, value ranges, digit counts) give the base spans, which always
stay. Generators of higher recall propose further spans, also overlapping ones: obfuscated
addresses, numbers with other separators or without country code. Boosted trees judge each by
the format of the span and its context, not by the base pattern itself. They learn from the
candidates alone: those that a base span lies in are positive (telephone numbers also without their country code), those that break the kind's own
rules (check digit, ranges, counts, letters attached) are negative, all others are left out of
the fit. A threshold per kind, the lowest whose precision on the other half of the texts is
at least ``PRECISION``, selects the spans that are added; of overlapping ones the first stays.

Only DataFrame functions and the DataFrame API for trees are used. The fit takes the candidates
of all documents, those of equal texts once: texts with candidates are shuffled by their hash.
Trees and thresholds see each distinct vector of features once, weighted by how often it occurs.

Defined results: NULL and empty texts have no spans; offsets are code points, the end exclusive;
repeated rows and NULL ids are treated row by row; if the texts lack positive or negative
candidates, no span is added to the base; extra columns are carried, never confused.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, query, table

KINDS = ("email", "ip", "card", "phone")
#: Start of the base patterns' runs: at a run's first character or right behind the last match,
#: so that a long run is tried once and not from each of its characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?@\x20?|\x20?[(\[{]\x20?(?i:at)\x20?[)\]}]\x20?|\x20(?i:at)\x20(?=[A-Za-z0-9-]{1,63}+\x20(?i:dot)\x20))"
    r"[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[(\[{]\x20?(?i:dot)\x20?[)\]}]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]{1,63}+){1,5}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?(?:\.|\[\.\]|[(\[]dot[)\]])\x20?[0-9]{1,3}+){3}|(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![:0-9A-Fa-f])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/\u00A0-]{0,2}+[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9])\+?\(?[0-9]{1,4}+\)?(?:[\x20./\u00A0-]{0,2}+\(?[0-9]{2,4}+\)?){2,5}(?![0-9])",
}
#: A cheap test that a text can hold the kind at all.
POSSIBLE = {"email": r"@|(?i:\bat\b)", "ip": "[0-9a-fA-F][.:\\x20\\[(]", "card": "[0-9]", "phone": "[0-9]"}
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write|address|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|addr|login|network",
    "card": r"(?i)card|visa|master|amex|credit|pay|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|fax|mobile|cell|whatsapp",
}
FEATURES = (
    "email", "ip", "card", "phone", "length", "digits", "letters", "separators", "groups", "longest_group", "shortest_group",
    "parens", "spelled", "luhn", "largest_part", "letter_before", "letter_after", "digit_near_before", "digit_near_after", "keyword",
)
PRECISION = 0.98
TREES, DEPTH = 12, 3
SPAN = "array<struct<kind:int,start:int,stop:int,text:string>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern in order, with their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.char_length)
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("spans"))

    def step(state, x):
        begin = state["at"] + x["gap"]
        end = begin + F.char_length(x["text"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("stop"), x["text"].alias("text"))
        spans = F.concat(F.coalesce(state["spans"], F.array().cast(SPAN)), F.array(span))
        return F.when(x["text"].isNull(), state).otherwise(F.struct(end.alias("at"), spans.alias("spans")))

    return F.coalesce(F.aggregate(F.arrays_zip(between.alias("gap"), found.alias("text")), start, step)["spans"], F.array().cast(SPAN))


def valid(kind: str, text: Column) -> Column:
    """The checks of a base match."""
    n = F.char_length(digits_of(text))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", digits_of(text))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _valid_only(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["text"]))


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _empty() -> Column:
    return F.array().cast(SPAN)


def base_spans(text: Column) -> Column:
    """The base spans of a text, kind by kind."""
    possible = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    parts = []
    for k, kind in enumerate(KINDS):
        found = _valid_only(kind, matches(text, BASE[kind], k))
        parts.append(F.when(possible.get(kind, text.rlike("[0-9]")), found).otherwise(_empty()))
    return F.concat(*parts)


def candidates(text: Column) -> Column:
    """The generators' spans, kind by kind; they may overlap each other and base spans."""
    parts = [F.when(text.rlike(POSSIBLE[kind]), matches(text, GENERATORS[kind], k)).otherwise(_empty()) for k, kind in enumerate(KINDS)]
    return F.concat(*parts)


def span_features(text: Column, span: Column) -> Column:
    """Format and context of a span as an array in the order of ``FEATURES``."""
    s, kind = span["text"], span["kind"]
    before = F.substring(text, F.greatest(F.lit(1), span["start"] - 23), F.least(F.lit(24), span["start"]))
    after = F.substring(text, span["stop"] + 1, F.lit(12))
    number = digits_of(s)
    groups = F.filter(F.split(s, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.char_length)
    parts = F.transform(groups, lambda g: F.when(F.char_length(g) <= 9, g.cast("int")).otherwise(999_999_999))
    keyword = reduce(lambda a, k: F.when(kind == k, before.rlike(CONTEXT[KINDS[k]])).otherwise(a), range(len(KINDS)), F.lit(False))
    values = [
        *[kind == k for k in range(len(KINDS))],
        F.char_length(s),
        F.char_length(number),
        F.char_length(F.regexp_replace(s, r"[^\p{L}]", "")),
        F.char_length(F.regexp_replace(s, r"[\p{L}0-9+]", "")),
        F.size(groups),
        F.coalesce(F.array_max(sizes), F.lit(0)),
        F.coalesce(F.array_min(sizes), F.lit(0)),
        F.contains(s, F.lit("(")),
        s.rlike(r"(?i)[\x20(\[{](?:at|dot)[\x20)\]}]"),
        F.char_length(number).between(12, 19) & F.call_function("luhn_check", number),
        F.coalesce(F.array_max(parts), F.lit(0)),
        before.rlike(r"[\p{L}_=\"]$"),
        after.rlike(r"^[\p{L}_=\"]"),
        before.rlike(r"[0-9][^\p{L}]{0,3}$"),
        after.rlike(r"^[^\p{L}]{0,3}[0-9]"),
        keyword,
    ]
    return F.array(*[v.cast("double") for v in values])


def _breaks_rules(x: Column) -> Column:
    """Whether a candidate cannot be of its kind, by its features."""
    f = {name: x["f"][i] for i, name in enumerate(FEATURES)}
    attached = (f["letter_before"] + f["letter_after"] > 0) & (f["email"] == 0)
    card = (f["card"] == 1) & (f["luhn"] == 0)
    ip = (f["ip"] == 1) & ((f["largest_part"] > 255) & (f["letters"] == 0))
    phone = (f["phone"] == 1) & (~f["digits"].between(9, 15) | ((f["groups"] == 1) & (f["parens"] == 0)))
    email = (f["email"] == 1) & (f["letters"] < 3)
    crowded = (f["email"] == 0) & (f["digit_near_before"] + f["digit_near_after"] > 0)
    return attached | card | ip | phone | email | crowded


def judged(spans: Column, base: Column, text: Column) -> Column:
    """Candidates with features and weak label: 1 a base span of the kind lies in it, 0 it breaks the rules, else NULL."""

    def judge(s):
        inside = F.exists(base, lambda b: (b["kind"] == s["kind"]) & (b["start"] >= s["start"]) & (b["stop"] <= s["stop"]))
        with_f = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), span_features(text, s).alias("f"))
        return F.struct(with_f.alias("x"), inside.alias("inside"))

    label = lambda y: F.when(y["inside"], 1.0).when(_breaks_rules(y["x"]), 0.0)
    return F.transform(F.transform(spans, judge), lambda y: F.struct(y["x"].alias("x"), label(y).alias("label")))


def _with_national_forms(spans: Column) -> Column:
    """For the fit, numbers with a country code also count with the code cut off (in place of it)."""
    foreign = F.filter(spans, lambda s: (s["kind"] == KINDS.index("phone")) & s["text"].startswith("+"))
    cut = lambda t: F.regexp_replace(t, r"^\+(?:1|[0-9]{2})[\x20.-]?", "")
    return F.concat(spans, F.transform(foreign, lambda s: F.struct(s["kind"], s["start"], s["stop"], cut(s["text"]).alias("text"))))


class SpanModel:
    """Boosted trees as text, their weights, and a threshold per kind."""

    def __init__(self, trees: list[tuple[float, list[str]]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, f: Column) -> Column:
        margin = sum((w * _tree_column(iter(lines), f) for w, lines in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def passes(self, kind: Column, score: Column) -> Column:
        least = reduce(lambda a, k: F.when(kind == k, F.lit(self.thresholds[k])).otherwise(a), self.thresholds, F.lit(2.0))
        return score >= least


def _tree_column(lines, f: Column) -> Column:
    """A tree's description as a nested CASE."""
    line = next(lines).strip()
    m = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line)
    if m is None:
        return F.lit(float(re.match(r"Predict: ([-\d.E]+)", line)[1]))
    yes = _tree_column(lines, f)
    next(lines)  # Else
    no = _tree_column(lines, f)
    return F.when(f[int(m[1])] <= float(m[2]), yes).otherwise(no)


def fit_spans(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Fit trees and thresholds on the candidates of all documents, equal texts once."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = texts.withColumn("spans", candidates(F.col("text"))).where(F.size("spans") > 0)
    distinct = found.withColumn("order", F.xxhash64("text")).dropDuplicates(["order"])
    labelled = (
        distinct.select("order", F.explode(judged(_with_national_forms(F.col("spans")), base_spans(F.col("text")), F.col("text"))).alias("s"))
        .select("order", "s.label", F.col("s.x.kind").alias("kind"), F.col("s.x.f").alias("f"))
        .where("label is not null")
        .withColumn("fit", F.pmod(F.xxhash64("order", F.lit("half")), F.lit(2)) == 0)
        .groupBy("fit", "kind", "label", "f")
        .agg(F.count("*").cast("double").alias("n"))
        .withColumn("features", array_to_vector("f"))
        .persist()
    )
    try:
        train = labelled.where("fit")
        if train.select("label").distinct().count() < 2:
            return SpanModel([], {})
        model = GBTClassifier(labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(train)
        trees = [(w, t.toDebugString.split("\n")[1:]) for w, t in zip(model.treeWeights, model.trees, strict=True)]
        spans = SpanModel(trees, {})
        other = labelled.where("not fit").select("kind", (F.floor(spans.score(F.col("f")) * 10_000) / 10_000).alias("score"), "label", "n")
        # At most 4 x 10,001 rows: scores are cut to four places.
        counts = other.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    finally:
        labelled.unpersist()
    for kind in range(len(KINDS)):
        good = n = 0
        for r in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["score"]):
            good, n = good + r["good"], n + r["n"]
            if good / n >= PRECISION and r["score"] >= 0.5:
                spans.thresholds[kind] = r["score"]
    return spans


def with_spans(docs: DataFrame, model: SpanModel, name: str = "spans", text_col: str = "text", base_name: str | None = None) -> DataFrame:
    """``docs`` with all spans under ``name`` (kind, start, stop), and the base spans alone if asked for."""
    columns = docs.columns
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base_col = base_name or fresh("base", [*columns, name])
    held = docs.withColumn(base_col, F.transform(base_spans(text), lambda s: F.struct(s["kind"], s["start"], s["stop"])))
    order = lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(a["kind"] - b["kind"]).cast("int")
    held = held.withColumn(base_col, F.array_sort(base_col, order))
    base = F.col(base_col)
    if not model.thresholds:
        made = held.withColumn(name, base)
    else:
        taken = lambda s: F.struct(s["kind"], s["start"], s["stop"])
        scored = F.transform(
            candidates(text), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), model.score(span_features(text, s)).alias("p"))
        )
        more = F.transform(F.filter(scored, lambda s: model.passes(s["kind"], s["p"])), taken)
        held = held.withColumn(name, F.when(text.rlike(r"[0-9@]|(?i:\bat\b)"), more).otherwise(F.slice(base, 1, 0)))
        made = held.withColumn(name, F.array_sort(_merged(base, F.col(name)), order))
    return made.select(*[F.col(f"`{c}`") for c in columns], name, *([base_name] if base_name else []))


def _merged(base: Column, more: Column) -> Column:
    """Base spans and, in order, those of the others that overlap nothing taken before."""
    tagged = F.array_sort(
        F.concat(
            F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))),
            F.transform(more, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))),
        )
    )
    kinds = "array<struct<kind:int,start:int,stop:int>>"
    ahead = "array<struct<kind:int,start:int,stop:int,rank:int,next:int>>"
    far = F.lit(2**31 - 1)
    # Backwards: the start of the next base span behind each span.
    back = F.aggregate(
        F.reverse(tagged),
        F.struct(far.alias("next"), F.array().cast(ahead).alias("out")),
        lambda a, s: F.struct(
            F.when(s["rank"] == 0, s["start"]).otherwise(a["next"]).alias("next"),
            F.concat(a["out"], F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["rank"].alias("rank"), a["next"].alias("next")))).alias("out"),
        ),
    )["out"]
    # Forwards: a span that is not base stays if it begins behind all taken and ends before the next base span.
    return F.aggregate(
        F.reverse(back),
        F.struct(F.lit(0).alias("end"), F.array().cast(kinds).alias("out")),
        lambda a, s: F.when(
            (s["rank"] == 0) | ((s["start"] >= a["end"]) & (s["stop"] <= s["next"])),
            F.struct(
                F.greatest(a["end"], s["stop"]).alias("end"),
                F.concat(a["out"], F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))).alias("out"),
            ),
        ).otherwise(a),
    )["out"]


def spelled(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans as one."""
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    end = F.char_length(text)
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(
        spans,
        state,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(s["stop"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(kinds, s["kind"])).alias("out")),
        ).otherwise(F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["out"].alias("out"))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(folded["out"], F.substring(text, folded["at"] + 1, end)))


def redact_documents(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; NULL texts stay NULL."""
    spans = fresh("spans", docs.columns)
    text = F.col(f"`{text_col}`").cast("string")
    return with_spans(docs, model, spans, text_col).withColumn(text_col, redacted(text, F.col(spans))).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op4_personal_data")
def op4_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, fit_spans(docs), "all_spans", base_name="base")
    counts = [_count("base", k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("all_spans")).alias("spans"))
