import re
from collections import Counter
from itertools import permutations

import numpy as np
from oracle import compare, duck

import __spark_entry__ as entry
from tidemark.llm.filter_audit import COUNTS, audit, filter_audit, orders, removal_steps


def brute(docs, labels):
    """Every order walked document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and smallest[text] < i,
        }
        rows.append((part or "", {f for f in failed if failed[f]}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                before = [r for r in rows if r[0] == part and f in r[1] and set(order[: step - 1]) & r[1]]
                alone = sum(r[0] == part and r[1] == {f} for r in rows)
                out[part, "".join(order), step] = [len(left), len(gone), len(before), alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    made = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in rows}
    assert len(made) == len(rows)
    return made


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op12_filter_audit"](spark, sf)
    assert got.dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int"), *((c, "bigint") for c in COUNTS)]
    assert compare(got, duck(sf), entry.oracle_sql()["op12_filter_audit"]) is None


def test_whole_test_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert found(entry.queries()["op12_filter_audit"](spark, sf)) == brute(docs, labels)


def test_odd_rows(spark):
    many = " ".join(f"w{i}" for i in range(200))
    texts = [
        None, "", " \t\n", many, many + " ", " " + many, many.upper(), "a " * 200_000, "a b " * 100 + "#",
        "ABC", "x|y", many + " $ END", "É" * 300, "A" * 3 + "b" * 97, "A" * 4 + "b" * 96, "w\x0bw\x0cw",
    ]
    docs = [(i, t, ["en", None, "", "de"][i % 4]) for i, t in enumerate(texts)]
    # Copies, in the other order of ids, in another part, without id, and with a repeated id.
    docs += [(50 - i, many, "en") for i in range(5)] + [(None, many, "en")] * 3 + [(None, None, None), (3, many, "fr"), (3, many, "fr"), (3, "x", "fr"), (-1, "ABC", "de")]
    labels = [(3, 1, 0), (3, 0, 1), (50, 1, 1), (None, 1, 1), (9, None, 1), (77, 1, 1), (-1, 7, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    df = df.selectExpr("*", "1 as id", "2 as part", "3 as key", "4 as mask", "5 as n", "6 as _words").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 as good", "2 as salt")
    assert found(filter_audit(df, marks)) == brute(docs, labels)
    assert found(filter_audit(df, marks.limit(0))) == brute(docs, [])
    assert filter_audit(df.limit(0), marks).collect() == []


def test_removal_steps_are_first_failures():
    order, positions = orders(4)
    masks = np.arange(16)
    got = removal_steps(masks, positions)
    for m in masks:
        for r, o in enumerate(order):
            assert got[m, r] == next((s for s, f in enumerate(o) if m >> f & 1), 4)


def test_sums_agree():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 50, (3, 32))
    made = audit(np.arange(32), weights, 5)
    assert (made["kept"][:, -1] == weights[0, 0]).all()  # only those that fail nothing stay
    assert (made["removed"].sum(axis=1) + weights[0, 0] == weights[0].sum()).all()
    # Each order's filters share all that go: 120 times as many over all orders.
    assert made["shapley"][0].sum() == 120 * weights[0, 1:].sum()


def test_a_common_text_is_spread_over_tasks(spark):
    """One text in a third of the rows meets its first by text and id."""
    from tidemark.llm.filter_audit import judged, with_repeats

    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text", "'en' as lang")
    rows = with_repeats(judged(docs))
    assert rows.where("mask >= 16").count() == 999
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "Window" not in plan
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert joins and all("key" in x and "id" in x for x in joins)
