"""Token counts of whole texts by a trie of pre-tokens.

A pre-token is a word (a run of anything but ASCII white space) behind a blank mark. Its tokens
are the pieces of its best segmentation under a unigram model: the sum of the pieces' scores is
largest. The distinct pre-tokens of a slice of documents are put in a trie, held as sorted rows
with the node of every prefix; forward scores (the best score of a prefix and its number of
tokens) are computed once per node, depth by depth for all nodes of that depth together, and
read off at the terminal nodes. A document's count is the sum over its words.

It is one narrow pass: nothing is shuffled, and a task holds the trie of one slice (at most
``SLICE`` characters of text, one document at least).

Defined results: NULL and empty texts count 0; a character that no piece covers counts as its
UTF-8 bytes and scores ``unknown`` below the worst piece; among equal scores the segmentation
with the shortest last piece is taken; repeated rows and NULL ids are counted row by row; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.llm.piece_encoding import BLANK, model_proto

SLICE = 8_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEED = np.uint64(0xD6E8FEB86659FD93)


class UnigramTrie:
    """Best segmentations of many words at once under a unigram model."""

    def __init__(self, scores: dict[str, float], unknown: float = 10.0):
        self.unknown = min(scores.values(), default=0.0) - unknown
        by_length: dict[int, list[tuple[int, float]]] = {}
        for piece, score in scores.items():
            by_length.setdefault(len(piece), []).append((self._key(piece), score))
        self.tables = {}
        for length, rows in by_length.items():
            keys = np.array([k for k, _ in rows], np.uint64)
            order = np.argsort(keys)
            if len(np.unique(keys)) != len(keys):
                raise ValueError("two pieces share a hash")
            self.tables[length] = keys[order], np.array([s for _, s in rows])[order]

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for i, c in enumerate(reversed(piece)):
            h = (h + (ord(c) + int(_SEED)) * pow(int(_BASE), i, 1 << 64)) % (1 << 64)
        return h

    def best(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens and score of every word."""
        counts, scores = np.zeros(len(words), np.int64), np.zeros(len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        # Words of similar length share a trie, so that the rows of a trie are of bounded width.
        low = 0
        for high in (16, 64, 1024):
            picked = np.flatnonzero((lengths > low) & (lengths <= high))
            for part in np.array_split(picked, max(1, -(-len(picked) * high // 16_000_000))):
                if len(part):
                    counts[part], scores[part] = self._trie([words[i] for i in part], high)
            low = high
        for i in np.flatnonzero(lengths > low):
            counts[i], scores[i] = (x[0] for x in self._trie([words[i]], int(lengths[i])))
        return counts, scores

    def _trie(self, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        order = sorted(range(len(words)), key=words.__getitem__)
        text = "".join([words[i].ljust(width, "\0") for i in order])
        rows = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width).copy()
        size = np.array([len(words[i]) for i in order])
        rows[np.arange(width) >= size[:, None]] = 0xFFFFFFFF  # no character
        deepest = int(size.max())
        longest = min(max(self.tables, default=0), deepest)
        counts, scores = np.zeros(len(words), np.int64), np.zeros(len(words))
        # Of the last ``longest`` depths: the node of every row, and the nodes' forward scores.
        node: dict[int, np.ndarray] = {0: np.zeros(len(words), np.int64)}
        forward: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (np.zeros(1), np.zeros(1, np.int64))}
        differs = np.zeros(len(words), bool)
        differs[0] = True
        for d in range(1, deepest + 1):
            differs[1:] |= rows[1:, d - 1] != rows[:-1, d - 1]
            node[d] = np.cumsum(differs) - 1
            first = np.flatnonzero(differs)
            alive = size[first] >= d
            first_alive = first[alive]
            best = np.full(len(first), -np.inf)
            tokens = np.zeros(len(first), np.int64)
            s = np.full(len(first_alive), -np.inf)
            t = np.zeros(len(first_alive), np.int64)
            h = np.zeros(len(first_alive), np.uint64)
            power = np.uint64(1)
            with np.errstate(over="ignore"):
                for length in range(1, min(longest, d) + 1):
                    c = rows[first_alive, d - length]
                    h = h + (c.astype(np.uint64) + _SEED) * power
                    power = power * _BASE
                    before_s, before_t = (x[node[d - length][first_alive]] for x in forward[d - length])
                    if length == 1:
                        s = before_s + self.unknown
                        t = before_t + 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
                    if length not in self.tables:
                        continue
                    keys, values = self.tables[length]
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    value = np.where(keys[at] == h, before_s + values[at], -np.inf)
                    # A piece of one character takes the place of the unknown one.
                    better = (value > s) | ((length == 1) & (keys[at] == h))
                    s = np.where(better, value, s)
                    t = np.where(better, before_t + 1, t)
            best[alive], tokens[alive] = s, t
            forward[d] = best, tokens
            ends = np.flatnonzero(size == d)
            counts[ends], scores[ends] = tokens[node[d][ends]], best[node[d][ends]]
            node.pop(d - longest, None)
            forward.pop(d - longest, None)
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        return counts[back], scores[back]


def public_scores(proto: bytes) -> dict[str, float]:
    """Scores for a public vocabulary: the logarithm of a Zipf law over the ranks of its pieces."""
    import sentencepiece

    v = sentencepiece.SentencePieceProcessor(model_proto=proto)
    skip = lambda i: v.is_byte(i) or v.is_control(i) or v.is_unknown(i) or v.is_unused(i)
    pieces = [v.id_to_piece(i) for i in range(v.vocab_size()) if not skip(i)]
    return {p: -log(r + 2) for r, p in enumerate(pieces)}


def count_tokens(docs: DataFrame, scores: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, tokens and score of the best segmentation of its whole text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = UnigramTrie(scores)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            start = 0
            while start < len(texts):
                stop, held = start, 0
                while stop < len(texts) and (stop == start or held + len(texts[stop] or "") <= SLICE):
                    held += len(texts[stop] or "")
                    stop += 1
                yield _counted(trie, batch.slice(start, stop - start), texts[start:stop])
                start = stop

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {picked.schema['id'].dataType.simpleString()}, n_words bigint, n_tokens bigint, score double"
    return picked.mapInArrow(counted, schema).withColumnRenamed("id", id_col)


def _counted(trie: UnigramTrie, batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
    place: dict[str, int] = {}
    per_doc: list[np.ndarray] = []
    for t in texts:
        words = _words(t or "")
        per_doc.append(np.fromiter([place.setdefault(w, len(place)) for w in words], np.int64, len(words)))
    counts, scores = trie.best([BLANK + w for w in place])
    made = [
        batch.column(0),
        pa.array([len(w) for w in per_doc], pa.int64()),
        pa.array([int(counts[w].sum()) for w in per_doc], pa.int64()),
        pa.array([float(scores[w].sum()) for w in per_doc], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(made, names=["id", "n_words", "n_tokens", "score"])


_BLANKS = str.maketrans(dict.fromkeys(map(chr, range(9, 14)), " "))


def _words(text: str) -> list[str]:
    return [w for w in text.translate(_BLANKS).split(" ") if w]


@query("op3_trie_token_counts")
def op3_trie_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_scores(model_proto()))
