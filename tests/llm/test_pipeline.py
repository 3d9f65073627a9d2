import re

import pyarrow as pa
import pytest
import sentencepiece
from test_decontamination import brute as brute_leaks
from test_near_copies import brute as brute_components
from test_personal_data import base

import corpus_pipeline
from tidemark.llm.common import BATCH_CONF, BATCH_ROWS, ship_code
from tidemark.llm.personal_data import KINDS
from tidemark.llm.piece_encoding import model_proto
from tidemark.llm.quality import fit_quality, score_quality

SF = "/root/testdata/sf0.01"


def redacted(text):
    spans = [s.split(":") for s in base(text).split(",") if s]
    out, at = "", 0
    for kind, start, end in spans:
        if int(start) >= at:
            out += text[at : int(start)] + f"<{kind.upper()}>"
        at = max(at, int(end))
    return out + text[at:]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = fit_quality(docs, labels)
    scores = {r.doc_id: r.score for r in score_quality(docs, model, ["doc_id"]).collect()}
    good = {i: t for i, t in rows.items() if scores[i] >= 0.5}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert sum((i in good) == (q == 1) for i, q in marked.items()) >= 0.98 * len(marked)
    component = brute_components(sorted(good.items()), corpus_pipeline.SIMILAR_PERCENT)
    single = {i: t for i, t in good.items() if component[i][1] == i}
    leaks = {d for d, _ in brute_leaks(single.items(), [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])}
    clean = {i: t for i, t in single.items() if i not in leaks}
    assert len(rows) > len(good) > len(single) > len(clean) > 0.5 * len(rows)

    wanted = [good, single, clean]
    for (_, step), want in zip(corpus_pipeline.STAGES, wanted, strict=False):
        docs = corpus_pipeline.stage(step(spark, docs, SF), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id: r.text for r in docs.collect()} == want
    docs = corpus_pipeline.stage(corpus_pipeline.STAGES[3][1](spark, docs, SF), "test")
    got = {r.doc_id: r.text for r in docs.collect()}
    mark = re.compile("|".join(f"<{k.upper()}>" for k in KINDS))
    for i, t in clean.items():
        assert got[i] == redacted(t) or len(mark.findall(got[i])) > len(mark.findall(redacted(t)))
    assert any(mark.search(t) for t in got.values())
    library = sentencepiece.SentencePieceProcessor(model_proto=model_proto())
    last = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert len(last) == len(clean)
    for r in last:
        assert list(r.ids) == library.encode(got[r.doc_id]) and r.decoded == library.decode(list(r.ids))


def test_run_is_all_stages(spark):
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "n_tokens", "ids", "decoded"]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, tmp_path, empty):
    rows = [(1, "Plain words in a row, and some more of them.", 7, "x"), (None, None, 7, "x"), (2, "", None, "y"), (None, "mail a@b.cc now", 1, "z"), (1, "Plain words in a row, and some more of them.", 7, "x"), (3, "plain WORDS in a row, and some more of them.", 7, "x")]
    docs = spark.createDataFrame(rows[:0] if empty else rows, "doc_id bigint, text string, score int, spans string")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    columns = docs.columns
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stage(step(spark, docs, str(tmp_path)), "odd")
        assert k == 4 or docs.columns == columns
    kept = sorted((r.doc_id or 0, r.decoded) for r in docs.collect())
    assert kept == ([] if empty else [(0, ""), (0, "mail <EMAIL> now"), (1, rows[0][1]), (2, "")])


def test_batches_for_python_are_small_unless_the_session_says(spark):
    rows = lambda: {r.n for r in spark.range(3000, numPartitions=1).mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in it), "n bigint").collect()}
    was = spark.conf.getAll.get(BATCH_CONF)
    try:
        spark.conf.unset(BATCH_CONF)
        ship_code(spark)
        assert rows() == {BATCH_ROWS}
        spark.conf.set(BATCH_CONF, "1500")
        ship_code(spark)
        assert rows() == {1500}
    finally:
        spark.conf.set(BATCH_CONF, was) if was else spark.conf.unset(BATCH_CONF)
