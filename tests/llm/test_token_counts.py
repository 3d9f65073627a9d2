import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tidemark.llm.piece_encoding import BLANK, model_proto
from tidemark.llm.token_counts import UnigramTrie, count_tokens, public_scores

SCORES = public_scores(model_proto())
TRIE = UnigramTrie(SCORES)


def brute(word, scores=SCORES, unknown=TRIE.unknown):
    """Forward scores over one word, without a trie."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        c = word[end - 1]
        known = scores.get(c)
        s, t = best[end - 1]
        top = (s + known, t + 1) if known is not None else (s + unknown, t + len(c.encode()))
        for start in range(end - 2, -1, -1):
            value = scores.get(word[start:end])
            if value is not None and best[start][0] + value > top[0]:
                top = best[start][0] + value, best[start][1] + 1
        best.append(top)
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aehinorst,.é😀\x00\x01", max_size=30), min_size=1, max_size=30))
def test_like_brute_force(words):
    counts, scores = TRIE.best(words)
    for w, c, s in zip(words, counts, scores, strict=True):
        assert s == pytest.approx(brute(w)[0])
        assert c == brute(w)[1]


def test_like_the_library():
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *SCORES.items()], 0, False))
    words = [BLANK + w for w in "the retitioning eauenaux threshold ciónnes Enpfung a thttth onandthe".split()]
    assert TRIE.best(words)[0].tolist() == [len(library.encode(w).tokens) for w in words]


def test_long_words_and_widths():
    words = ["a" * 17, "the" * 30, "x" * 5000, "", "b"]
    counts, _ = TRIE.best(words)
    assert counts.tolist() == [brute(w)[1] for w in words]


def test_documents(spark):
    rows = [(1, "the of\n\tthé 😀", 5), (2, None, 5), (3, "  ", 5), (None, "the", 5), (1, "the of\n\tthé 😀", 5), (7, "th " * 100_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = count_tokens(docs, SCORES).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == [(0, 1), (1, 4), (1, 4), (2, 0), (3, 0), (7, 100_000)]
    for r in got:
        text = next(t or "" for i, t, _ in rows if i == r.doc_id)
        assert r.n_tokens == sum(brute(BLANK + w)[1] for w in text.split())
    assert count_tokens(docs.limit(0), SCORES).count() == 0


def test_whole_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    known = {}
    for r in docs.collect():
        want[r.doc_id] = sum(known.setdefault(w, brute(BLANK + w)[1]) for w in r.text.split())
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, SCORES).collect()}
    assert got == want and np.mean(list(got.values())) > 100
