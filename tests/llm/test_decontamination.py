import re
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from tidemark.llm.decontamination import CONSISTENCY, COVERAGE, NAMES, UNITS, WINDOW, _windows, drop_leaks, find_leaks, words

ITEM = "If Anna walks 12 km in 3 hours then how far does Anna walk in 5 hours at the same speed?"
MOVED = "So if Bert walks 30 km in 4 hours then how far does Bert walk in 9 hours at the same speed? Yes."
MIXED = "So if Bert walks 30 km in 4 hours then how far does Carl walk in 9 hours at the same speed? Yes."


def template(text):
    t = re.sub(r"[A-ZÀ-ÖØ-Þ](?<=[^.!?\s]\s.)[^\W\d_'-]*(?:['-][^\W\d_]*)*", "\x01", text)
    t = re.sub(rf"[0-9](?<![^\W_].)[0-9.,:/]*(?:%|(?i:{UNITS})(?![^\W_]))?", "\x02", t)
    t = re.sub(rf"(?<=\x02\s)(?i:{UNITS})(?![^\W_])", "\x03", t)
    return plain(t)


def plain(text):
    return re.sub(r"[!-/:-@\[-`{-~]+", "", text.lower()).split()


def brute(docs, items):
    out = set()
    for d, text in docs:
        t, p = template(text or ""), plain(text or "")
        places = defaultdict(list)
        for k in range(len(t) - 4):
            places[tuple(t[k : k + 5])].append(k)
        for i, item in items:
            a, b = template(item), plain(item)
            windows = [k for k in range(len(a) - 4) if sum(w not in "\x01\x02\x03" for w in a[k : k + 5]) >= 2]
            if not windows:
                continue
            stretches = defaultdict(dict)
            for k in windows:
                for at in places.get(tuple(a[k : k + 5]), ()):
                    s = (at - k) // len(windows)
                    for x in (s, s + 1):
                        words = (b[k : k + 5], p[at : at + 5])
                        stretches[x][k] = min(stretches[x].get(k, words), words)
            for found in stretches.values():
                if len(found) < COVERAGE * len(windows):
                    continue
                pairs = {(x, y) for k, (u, v) in found.items() for x, y, w in zip(u, v, a[k : k + 5], strict=True) if w in "\x01\x02\x03"}
                if not pairs or len({x for x, _ in pairs}) / len(pairs) >= CONSISTENCY:
                    out.add((d, i))
    return out


def found(df):
    return {(r.doc, r.item) for r in df.collect()}


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, "short one"), (3, None), (4, "10 20 30 40 50 60"), (None, "de la que el en los y a por")], "item_id bigint, text string")


def test_reparameterised_questions(spark, benchmark):
    rows = [(1, "x " * 500 + ITEM), (2, MOVED), (3, MIXED), (4, None), (5, ""), (6, "10 20 30 40 50 60"), (7, "if Anna walks 12 km in 3 hours"), (8, "que el en de la que el en los y a por"), (8, "que el en de la que el en los y a por"), (None, MOVED), (None, "clean")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as at", "'h' as hash", "2 as item", "3 as stretch")
    got = find_leaks(docs, benchmark).collect()
    assert {(r.doc, r.item, r.exact) for r in got} == {(1, 1, True), (2, 1, False), (None, 1, False), (8, None, True)}
    assert found(find_leaks(docs, benchmark)) == brute(rows, [(i, t or "") for i, t in ((r.item_id, r.text) for r in benchmark.collect())])
    kept = drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted((i or 0, t or "") for i, t in rows if i not in (1, 2, 8) and t != MOVED)
    assert find_leaks(docs.limit(0), benchmark).count() == 0
    assert find_leaks(docs, benchmark.limit(0)).count() == 0


def test_whole_test_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert want and found(find_leaks(docs, benchmark)) == want


def test_no_python_in_the_plan(spark, benchmark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string")
    plan = find_leaks(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


SHAPED = "Tom has 3 apples and Ann has 5 apples and Bob has 7 apples"


def aligned(text, item):
    """Whether some diagonal alone holds the item with consistent slots."""
    a, b, t, p = template(item), plain(item), template(text), plain(text)
    windows = [k for k in range(len(a) - 4) if sum(w not in "\x01\x02\x03" for w in a[k : k + 5]) >= 2]
    for d in range(-len(a), len(t)):
        hit = [k for k in windows if k + d >= 0 and t[k + d : k + d + 5] == a[k : k + 5]]
        pairs = {(b[k + j], p[k + d + j]) for k in hit for j in range(5) if a[k + j] in "\x01\x02\x03"}
        if len(hit) >= COVERAGE * len(windows) and (not pairs or len({x for x, _ in pairs}) / len(pairs) >= CONSISTENCY):
            return True
    return False


def test_repeating_shapes_wherever_they_stand(spark):
    renamed = "Tim has 4 apples and Eve has 6 apples and Joe has 8 apples"
    mixed = "Tim has 4 apples and Eve has 6 apples and Tim has 4 apples"
    rows = [(100 * n + k, "x " * k + "so " + t) for n, t in enumerate((SHAPED, renamed, SHAPED + " and Jim has 9 apples", mixed)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, SHAPED)], "item_id bigint, text string")
    got = find_leaks(docs, items).collect()
    want = {i for i, t in rows if aligned(t, SHAPED)}
    assert want >= set(range(20)) | {100 + k for k in range(20)} | {200 + k for k in range(20)}
    assert {r.doc for r in got} == want
    assert all(r.exact for r in got if r.doc < 20)


def test_shape_with_a_word_put_in(spark):
    gapped = SHAPED.replace("and Bob", "and then Bob")
    items = spark.createDataFrame([(1, "One day long ago " + SHAPED + " so how many apples do they have in all when they meet again at home")], "item_id bigint, text string")
    text = items.first().text.replace("and Bob", "and then Bob")
    assert gapped in text
    docs = spark.createDataFrame([(k, "x " * k + text) for k in range(20)], "doc_id bigint, text string")
    assert {r.doc for r in find_leaks(docs, items).collect()} == set(range(20))


def test_names_that_open_sentences_other_case_and_short_items(spark):
    shop = "Anna buys 3 pens at the new shop. Anna gives 2 of them to a friend. How many pens does Anna have now?"
    items = [(1, shop), (2, "Red Green"), (3, "Anna Bert Carl Dora Emil"), (4, "seven green bottles hanging"), (5, "Anna")]
    renamed = shop.replace("Anna", "Bert").replace("3", "8")
    rows = [
        (1, renamed), (2, "x. " + renamed), (3, shop.upper()), (4, shop.lower()), (5, "so " + shop.lower().replace("3", "9")),
        (6, "Bert buys 8 pens at the new shop. Carl gives 4 of them to a friend. How many pens does Dora have now?"),
        (7, "all red green ones"), (8, "then Anna Bert Carl Dora Emil came"), (9, "SEVEN GREEN BOTTLES HANGING"), (10, "Anna buys pens"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found(find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == {(k, 1) for k in range(1, 6)} | {(7, 2), (8, 3), (9, 4)}


def test_texts_are_cut_into_words_once_for_each_form(spark, benchmark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "doc bigint, text string").write.parquet(f"{tmp_path}/docs")
    hashed = _windows(spark.read.parquet(f"{tmp_path}/docs"), "doc", lengths=(2,))
    plan = hashed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 + len(NAMES)
    assert "array_distinct" not in plan


def test_words_with_any_white_space_and_punctuation(spark):
    texts = ["", " ", "a", " a  b\t", "\ta \n b\x00c\x0b", "a - b", "- a", "a -", "a\n", "a \x00 b", "Don't (STOP) a_b ~x~ [1] {2} ^3 `4` \\5 |", "é\u2028ß\u00a0ü “q” —", "a    b \r\n\r\n c"]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = spark.createDataFrame(rows, "k int, t string").select("k", words(F.col("t")).alias("w")).collect()

    def cut(text):
        return re.sub(r"[\x00 \t\n\x0b\f\r]+", " ", re.sub(r"[!-/:-@\[-`{-~]+", "", text.lower())).strip(" ").split(" ")

    assert {r.k: r.w for r in got} == {k: cut(t) for k, t in rows}


def test_windows_have_one_row_for_each_different_form(spark):
    rows = [(1, "so then Bert has five pens"), (2, "all in small letters here"), (3, "One Two"), (4, ""), (5, "x")]
    docs = spark.createDataFrame(rows, "doc bigint, text string")
    counts = {}
    for r in _windows(docs, "doc", lengths=(2,)).collect():
        counts.setdefault((r.doc, r.at), []).append(r.hash)
    assert all(len(set(h)) == len(h) for h in counts.values())
    # Windows of five words and of two; a name inside a sentence gives two forms, one that opens it too.
    want = {(1, 0): 2 + 1, (1, 1): 2 + 2, (1, 2): 2, (1, 3): 1, (1, 4): 1, (2, 0): 2, (2, 1): 1, (2, 2): 1, (2, 3): 1, (3, 0): 3}
    assert {k: len(h) for k, h in counts.items()} == want and WINDOW == 5
