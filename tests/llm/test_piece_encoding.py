import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.piece_encoding import PieceModel, encode_documents, model_proto


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=model_proto())


MODEL = PieceModel(model_proto())
FIXED = ["", " ", "a  b", " a", "\n a\tb", "a ", "▁a", "日本　語", "😀\x00b", "a\r\nb", "<s>x</s>", "<0x41>", "aaaaaaa", "    x", "x" * 3000, "é" * 50 + " ç"]


@pytest.mark.parametrize("text", FIXED)
def test_like_library_on_fixed_texts(library, text):
    ids = MODEL.encode(text)
    assert ids == library.encode(text)
    assert MODEL.decode(ids) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aehinorst .,\nTH▁éç1😀"), max_size=40))
def test_like_library_on_random_texts(text):
    library = sentencepiece.SentencePieceProcessor(model_proto=model_proto())
    ids = MODEL.encode(text)
    assert ids == library.encode(text)
    assert MODEL.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("ids", [[3, 131], [198, 137, 5, 300], [1, 300, 2], [243, 162, 300], [300, 131, 131]])
def test_decodes_broken_bytes_like_library(library, ids):
    assert MODEL.decode(ids) == library.decode(ids)


def test_documents_with_odd_rows(spark, library):
    rows = [(1, "The of théré\n\nis", "x"), (2, None, "x"), (3, "", None), (None, "two", "y"), (1, "The of théré\n\nis", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = encode_documents(docs, model_proto(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == 5
    texts = {(r[0], r[1]) for r in rows}
    for r in got:
        text = next(t or "" for i, t in texts if i == r.doc_id)
        ids = library.encode(text)
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert encode_documents(docs.limit(0), model_proto()).count() == 0


def test_whole_test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: library.encode(r.text) for r in docs.collect()}
    for r in encode_documents(docs, model_proto(), ("ids", "decoded")).collect():
        assert list(r.ids) == want[r.doc_id]
        assert r.decoded == library.decode(want[r.doc_id])


def test_fixed_texts_as_documents(spark, library, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(FIXED)], "doc_id bigint, text string")
    for r in encode_documents(docs, model_proto(), ("ids", "decoded")).collect():
        assert list(r.ids) == library.encode(FIXED[r.doc_id])
        assert r.decoded == library.decode(list(r.ids))
    # Whatever is forgotten on the way, the results are the same.
    monkeypatch.setattr("tidemark.llm.piece_encoding.REMEMBERED", 8)
    model = PieceModel(model_proto())
    for t in [*FIXED, "the of and on a in the of x y z é ▁▁ w"]:
        ids, decoded = model.encode_and_decode(t)
        assert [int(i) for i in ids.split(",")[:-1]] == library.encode(t)
        assert decoded == library.decode(library.encode(t))


def test_last_match_from_a_position_is_the_longest():
    text = "▁the▁internationalisation,▁the the"
    longest = {}
    for end, (back, p) in MODEL.automaton.iter(text):
        assert text[end - back : end + 1] == p and back + 1 > len(longest.get(end - back, ""))
        longest[end - back] = p
    assert longest == {k: next(p for n in range(len(text), k, -1) if (p := text[k:n]) in MODEL.id) for k in longest}
