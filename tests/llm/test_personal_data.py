import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.llm.personal_data import KINDS, SpanModel, fit_spans, redact_documents, spelled, with_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


TEXTS = [
    None, "", "mail a.b@c.de, or a@b a@b.c_d@e.f x@y.z.w@q.r", "ip 1.2.3.4.5.6.7.8 and 256.1.1.1, 001.02.3.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4275447196961570", "call +1 (975) 555-9967 or +49 30 1234567. +1+2 +3 45",
    "é😀 x@y.zz é", "1" * 50_000, "a" * 50_000 + "@b.c", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 " * 500, "+" * 1000, "a@b.c" * 300,
    "x@1.2.3.4 +1 2345678901 4111 1111 1111 1111",
]


def test_base_spans_like_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string").selectExpr("*", "1 as spans", "2 as base")
    got = with_spans(docs, SpanModel([], {}), "found").select("doc_id", spelled(F.col("found")).alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == {i: base(t or "") for i, t in enumerate(TEXTS)}


def test_whole_test_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in entry.queries()["op4_personal_data"](spark, sf).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        want = base(docs[i])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in KINDS]
        spans = [(int(s), int(e)) for _, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert spans == sorted(spans) or len({s for s, _ in spans}) < len(spans)


@pytest.fixture(scope="module")
def trained(spark):
    rows = []
    for i in range(400):
        n = f"{200 + i} 555-{1000 + 7 * i}"
        rows += [(f"call me at +1 ({n[:3]}){n[3:]} today {i}",), (f"order {10**11 + i * 977} shipped, ref x{i * 31}y",), (f"write to user{i}@mail{i % 5}.example.com now",), (f"sizes {i}.{i + 1}.{i + 900}.{i + 2}",)]
    return fit_spans(spark.createDataFrame(rows, "text string"))


def test_trees_add_spans_beyond_the_base(spark, trained):
    texts = ["phone (975) 555-9967 please", "x" * 3000 + " nothing here", "order 100000000977 shipped, ref x31y", "write to joe (at) mail3 (dot) example.com now", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in with_spans(docs, trained).select("doc_id", spelled(F.col("spans")).alias("spans")).collect()}
    assert got[1] == got[2] == got[4] == ""
    assert got[0].startswith("phone:6:")
    red = {r.doc_id: r.text for r in redact_documents(docs, trained).collect()}
    assert red[0] == "phone <PHONE> please" and red[1] == texts[1] and red[4] is None


def test_redaction(spark):
    rows = [(1, "to a@b.cc or +1 (975) 555-9967é", "s"), (None, None, None), (1, "to a@b.cc or +1 (975) 555-9967é", "s"), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = redact_documents(docs, SpanModel([], {}))
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "", r.spans or "") for r in got.collect()) == [(0, "", ""), (1, "to <EMAIL> or <PHONE>é", "s"), (1, "to <EMAIL> or <PHONE>é", "s"), (3, "", "x")]
    assert redact_documents(docs.limit(0), SpanModel([], {})).count() == 0
    assert fit_spans(docs.limit(0)).thresholds == {}


def test_no_python_in_the_plan(spark, trained):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    plan = with_spans(docs, trained)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fit_takes_all_documents(spark):
    """A kind that only texts with the largest hashes hold has a threshold of its own."""
    many = spark.range(24_000).selectExpr("concat('order ', 100000000000 + id * 977, ' shipped, ref x', id * 31, 'y') as text")
    last = spark.range(8_000).selectExpr("concat('write to user', id, '@mail', id % 5, '.example.com now') as text").where("xxhash64(text) > 8800000000000000000")
    assert 100 < last.count() < 1_000
    assert KINDS.index("email") in fit_spans(many.unionByName(last)).thresholds
