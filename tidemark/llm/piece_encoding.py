"""SentencePiece encoding by backtracking, and decoding.

The merge rule of a BPE piece model (join the adjacent pair whose joined piece scores best,
leftmost first) is reproduced without running the merges over the text:

* an Aho-Corasick automaton over the pieces gives the longest piece at every position;
* a piece may follow another only if merging the characters of both from scratch gives
  exactly these two pieces again (the compatibility check, remembered per pair);
* positions from which no piece can be placed are marked in a bitfield, so that the search
  never tries them twice.

No piece has a blank mark behind another character, so a text falls into independent
stretches (blank marks with the characters behind them), which the model's own pieces prove
when it is loaded. Stretches are remembered while a Python worker lives, up to a bound.

Defined results: NULL text counts as empty; an empty text has no ids and decodes to itself;
characters without a piece become their UTF-8 bytes; repeated rows and NULL ids are encoded row
by row; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, query, table

BLANK = "▁"
#: Stretches that a worker remembers at most; beyond, it starts anew.
REMEMBERED = 400_000
OUTPUTS = {
    "n_tokens": pa.int64(),
    "ids": pa.list_(pa.int32()),
    "decoded": pa.string(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
SQL_TYPES = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


class PieceModel:
    """The pieces and scores of a model, with encoding and decoding of whole texts."""

    def __init__(self, proto: bytes):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.piece = [vocabulary.id_to_piece(i) for i in range(vocabulary.vocab_size())]
        kinds = {i: self._kind(vocabulary, i) for i in range(len(self.piece))}
        self.byte_of = {i: int(self.piece[i][3:5], 16) for i, k in kinds.items() if k == "byte"}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no piece for every byte")
        self.id = {self.piece[i]: i for i, k in kinds.items() if k == "normal"}
        self.score = {p: vocabulary.get_score(i) for p, i in self.id.items()}
        self.control = {i for i, k in kinds.items() if k == "control"}
        self.shown = ["" if i in self.control else p.replace(BLANK, " ") for i, p in enumerate(self.piece)]
        self.automaton = ahocorasick.Automaton()
        for p in self.id:
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        # Prefixes of a piece that are pieces themselves, the longest first.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), "") for p in self.id}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.stretch = re.compile(self._stretches())
        self.known = _Remembered(self)

    @staticmethod
    def _kind(vocabulary, i: int) -> str:
        if vocabulary.is_byte(i):
            return "byte"
        if vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_unused(i):
            return "control"
        return "normal"

    def _stretches(self) -> str:
        """The pattern of stretches that no piece crosses."""
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            return r"(?s).+"
        alone = "".join(c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in self.id))
        return rf"{BLANK}*[^{BLANK}{re.escape(alone)}]+|{BLANK}+" + (f"|[{re.escape(alone)}]" if alone else "")

    def merged(self, text: str) -> list[str]:
        """The merge rule itself, on a short text."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Whether merging both pieces' characters leaves just these two pieces."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self.merged(left + right) == [left, right]
        return known

    def encode_stretch(self, text: str) -> list[int]:
        n = len(text)
        if n == 1:
            return self._ids(text)
        longest: list[str] = [""] * n
        # Ends come in order, so that the last piece from a position is the longest.
        for end, (back, p) in self.automaton.iter(text):
            longest[end - back] = p
        failed = 0
        placed: list[str] = []
        pos, token = 0, longest[0] or text[0]
        while True:
            last = placed[-1] if placed else None
            while token:
                end = pos + len(token)
                if not failed >> end & 1 and (last is None or self.fit(last, token)):
                    break
                token = self.shorter.get(token, "")
            if token:
                placed.append(token)
                pos = end
                if pos == n:
                    return [i for p in placed for i in self._ids(p)]
                token = longest[pos] or text[pos]
            else:
                failed |= 1 << pos
                if last is None:
                    raise ValueError(f"no encoding for {text[:40]!r}")
                placed.pop()
                pos -= len(last)
                token = last

    def _ids(self, piece: str) -> list[int]:
        known = self.id.get(piece)
        if known is not None:
            return [known]
        return [self.byte_id[b] for b in piece.encode("utf-8", "surrogatepass")]

    def stretches(self, text: str) -> list[str]:
        return self.stretch.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for s in self.stretches(text) for i in self.encode_stretch(s)]

    def encode_and_decode(self, text: str) -> tuple[str, str]:
        """The ids as text with a comma behind each, and the text decoded from them.

        A slice of the stretches at a time, so that what was remembered is not forgotten
        before it is used.
        """
        stretches = self.stretches(text)
        ids, decoded = [], []
        for at in range(0, len(stretches), REMEMBERED // 4):
            part = stretches[at : at + REMEMBERED // 4]
            if len(self.known) + len(self.known.decoded) + len(part) > REMEMBERED:
                self.known.clear()
                self.known.decoded.clear()
            ids += [self.known[s] for s in part]
            decoded.append(self.known.text(part))
        # The first stretch opens with the blank that encoding put there.
        return "".join(ids), "".join(decoded).removeprefix(" ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, runs of bytes read as UTF-8, the first blank dropped."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(self.shown[i])
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out).removeprefix(" ")


class _Remembered(dict):
    """Stretch -> its ids as text with a comma behind each.

    Its ids are decoded once. Where that gives anything but the stretch with its marks as
    blanks, the decoded text is kept in ``decoded``.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.decoded: dict[str, str] = {}

    def __missing__(self, stretch: str) -> str:
        ids = self.model.encode_stretch(stretch)
        text = self.model.decode([self.model.id[BLANK], *ids])
        if text != stretch.replace(BLANK, " "):
            self.decoded[stretch] = text
        value = "".join([f"{i}," for i in ids])
        if len(stretch) <= 40:
            self[stretch] = value
        return value

    def text(self, stretches: list[str]) -> str:
        """The decoded text of stretches looked up just before."""
        if not self.decoded:
            return "".join(stretches).replace(BLANK, " ")
        return "".join([self.decoded[s] if s in self.decoded else s.replace(BLANK, " ") for s in stretches])


def _utf8(run: bytes) -> str:
    """Bytes as UTF-8; each byte that is not part of a character becomes U+FFFD."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + n].decode("utf-8"))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def _model(proto: bytes) -> PieceModel:
    return PieceModel(proto)


def encode_documents(
    docs: DataFrame,
    proto: bytes,
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode and decode the text of every row: the id and the ``outputs`` asked for.

    One narrow pass; nothing is shuffled, and a worker holds one slice of a batch.
    """

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = _model(proto)
        made: dict[str, list] = {k: [] for k in outputs}
        for text in batch.column(1).to_pylist():
            ids, decoded = model.encode_and_decode(text or "")
            for k, column in made.items():
                if k == "n_tokens":
                    column.append(ids.count(","))
                elif k == "ids":
                    column.append([int(i) for i in ids.split(",")[:-1]])
                elif k == "decoded":
                    column.append(decoded)
                elif k == "ids_sha256":
                    column.append(hashlib.sha256(ids[:-1].encode()).hexdigest())
                else:
                    column.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
        arrays = [batch.column(0), *(pa.array(v, OUTPUTS[k]) for k, v in made.items())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", *outputs])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {picked.schema['id'].dataType.simpleString()}, " + ", ".join(f"{k} {SQL_TYPES[k]}" for k in outputs)
    return picked.mapInArrow(per_batch(encode, 200), schema).withColumnRenamed("id", id_col)


def model_proto(path: str | None = None) -> bytes:
    """The model file's bytes; by default the public 32k piece model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


@query("op8_piece_encoding")
def op8_piece_encoding(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), model_proto(), ("n_tokens", "ids_sha256", "decoded_sha256"))
