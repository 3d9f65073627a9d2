"""Language-model scores by a probabilistic suffix tree.

A text is a sequence of tokens: its words with A-Z lower-cased, then one end. Tokens are spelled
in bytes (a word with a blank behind it, the end as a line feed). The tree has two storeys:

* Byte contexts predict the spelling. Counts of all byte strings one longer than the longest
  context are summed over the training documents; those of shorter contexts follow from them. A
  context is retained if it makes up at least ``LEAST_SHARE`` of all positions and its next-byte
  distribution diverges from that of the context one shorter (count times relative entropy above
  ``DIVERGENCE``). That bounds this storey to ``CONTEXT / LEAST_SHARE`` contexts whatever the
  corpus, so that it may be sent to every task. Every byte is predicted from the longest suffix
  of the bytes before it that the tree holds, followed as an automaton over many stretches of
  text at once; distributions are smoothed by that of the next shorter context.
* Word contexts predict whole tokens: the last words that make up ``WORD_CONTEXT`` bytes. One
  is retained if its next-token distribution diverges from the memoryless one by more than it
  takes to list its different next tokens; else the token is predicted without context, by a
  mixture of its count and its spelling (weighted by the share of words met once). A retained
  context's distribution is smoothed by that mixture (Witten-Bell).

Counts of words and word contexts grow with the corpus, and are neither collected nor
broadcast: blocks of documents (what a task reads, some megabytes at a time) exchange packed counts
with parts of the key space. Word contexts,
and the next tokens within them, are known by hashes of some bits more than the logarithm of the
number of bytes, so that hardly any two of the corpus share one.

Defined results: NULL texts count as empty and are scored as the end alone; NULL ids count as
the text '' for the split, and keep their row; repeated rows are separate documents; with no
training document the tree is the uniform distribution; extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import DEALT, Hashes, Wide, blocks_for, chunks, cut, dealt, keys_of, part_of, read_counts, small_counts, steady_splits, summed, task_blocks, task_packs
from tidemark.llm.common import LOWER_BYTES, query, stage, table

#: Longest context in bytes.
CONTEXT = 5
LEAST_SHARE = 1e-4
#: Least count times relative entropy (nats) of a retained context against the next shorter.
DIVERGENCE = 20.0
#: Weight of the shorter context's distribution in smoothing, in counts.
SMOOTHING = 4.0
#: Bytes of the shortest word context, which takes WORDS words at most.
WORD_CONTEXT, WORDS = 9, 4
#: Bits of a context's hash, and of a next token's within it, beyond log2 of the corpus.
SPARE_BITS = 10
END = b"\n"
_LANES = 4096
_BASE = 0x9E3779B97F4A7C15


def spelled_bytes(text: bytes) -> bytes:
    """The bytes of a text's tokens."""
    words = text.translate(LOWER_BYTES).split()
    return b" ".join(words) + (b" " if words else b"") + END


class Chunk:
    """Some documents of a block: bytes, tokens and their keys, with document bounds."""

    def __init__(self, ids, nulls, sizes, data: bytes, held_out_mod: int, bits: int):
        self.ids, self.nulls, self.sizes = ids, nulls, sizes
        named = ("" if null else str(i) for i, null in zip(ids.tolist(), nulls.tolist(), strict=True))
        self.train = np.array([zlib.crc32(x.encode()) % held_out_mod != 0 for x in named], bool)
        self.bytes = np.frombuffer(data, np.uint8)
        self.doc_start = np.cumsum(sizes) - sizes
        # A token ends with a blank or a line feed.
        ends = np.flatnonzero((self.bytes == 32) | (self.bytes == 10)) + 1
        self.token_start = np.r_[0, ends[:-1]].astype(np.int64)
        self.first_token = np.searchsorted(self.token_start, self.doc_start)
        self.tokens = np.diff(np.r_[self.first_token, len(ends)])
        hashes = Hashes(self.bytes)
        self.keys = hashes.of(self.token_start, ends)
        self.pairs = self._pairs(hashes, bits)

    def _pairs(self, hashes: Hashes, bits: int) -> Wide:
        """Per token, its word context's hash and its own, of ``bits`` each: the first 64 bits and the rest."""
        i = np.arange(len(self.keys))
        first = np.repeat(self.first_token, self.tokens)
        back = np.minimum(1, i - first)
        for _ in range(WORDS - 1):
            short = self.token_start - self.token_start[i - back] < WORD_CONTEXT
            back = np.where(short, np.minimum(back + 1, i - first), back)
        context = hashes.of(self.token_start[i - back], self.token_start)
        own = (self.keys * np.uint64(_BASE)) >> np.uint64(64 - bits)
        rest = _rest(bits)
        high = ((context >> np.uint64(64 - bits)) << np.uint64(64 - bits)) | (own >> np.uint64(rest))
        return Wide(high, own & np.uint64((1 << rest) - 1))

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first_token)

    def padded(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes with CONTEXT ends before every document, and the places of the bytes in it."""
        place = np.arange(len(self.bytes)) + np.repeat((np.arange(len(self.sizes)) + 1) * CONTEXT, self.sizes)
        stream = np.full(len(self.bytes) + CONTEXT * len(self.sizes), END[0], np.uint8)
        stream[place] = self.bytes
        return stream, place


def held_chunks(rows: pa.Table, held_out_mod: int, bits: int):
    return (Chunk(*c, held_out_mod, bits) for c in chunks(rows))


def _rest(bits: int) -> int:
    """Bits of a pair of hashes behind the first 64."""
    return max(0, 2 * bits - 64)


def _rest_bytes(bits: int) -> int:
    return -(-_rest(bits) // 8)


WORD, STRING, PAIR = 0, 1, 2
_DEALT = DEALT.set(1, pa.field("block", pa.int64()))


def block_counts(docs: DataFrame, parts: int, bits: int, held_out_mod: int) -> DataFrame:
    """(kind, part, block, keys, counts): packed counts of training tokens, byte strings and context pairs by block.

    Words and pairs of held-out documents are dealt with a count of 0, so that they are answered too.
    """

    def count(batches):
        for block, *texts in task_blocks(batches, spelled_bytes):
            yield from of_block(block, texts).to_batches()

    def of_block(block: int, texts: list) -> pa.Table:
        found = {kind: ([], []) for kind in (WORD, STRING)}
        pairs: list[Wide] = []
        pair_counts: list[np.ndarray] = []
        for c in (Chunk(*part, held_out_mod, bits) for part in cut(*texts)):
            trained = np.repeat(c.train, c.tokens)
            k, n = np.unique(c.keys, return_inverse=True)
            found[WORD][0].append(k)
            found[WORD][1].append(np.bincount(n, weights=trained, minlength=len(k)).astype(np.int64))
            k, n = c.pairs.distinct()
            pairs.append(k)
            pair_counts.append(np.bincount(n, weights=trained, minlength=len(k.high)).astype(np.int64))
            stream, place = c.padded()
            value = np.zeros(len(stream) - CONTEXT, np.uint64)
            for ahead in range(CONTEXT + 1):
                value = (value << np.uint64(8)) | stream[ahead : ahead + len(value)]
            k, n = np.unique(value[place[np.repeat(c.train, c.sizes)] - CONTEXT], return_counts=True)
            # Strings are no hashes: their own order would deal them unevenly.
            k = k * np.uint64(_BASE)
            order = np.argsort(k, kind="stable")
            found[STRING][0].append(k[order])
            found[STRING][1].append(n[order].astype(np.int64))
        tables = []
        for kind, (keys, counts) in found.items():
            made = dealt(block, *summed(keys, counts), parts, _DEALT)
            tables.append(_of_kind(made, kind, [None] * made.num_rows))
        every, place = Wide.joined(pairs).distinct()
        sums = np.bincount(place, weights=np.concatenate(pair_counts), minlength=len(every.high)).astype(np.int64)
        ends = np.r_[0, np.flatnonzero(np.diff(part_of(every.high, parts))) + 1, len(every.high)]
        rests = [every.take(slice(lo, hi)).packed(_rest_bytes(bits)) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        tables.append(_of_kind(dealt(block, every.high, sums, parts, _DEALT), PAIR, rests))
        return pa.concat_tables(tables)

    return docs.mapInArrow(count, "part int, block bigint, keys binary, counts binary, kind int, rests binary")


def _of_kind(made: pa.RecordBatch, kind: int, rests: list[bytes | None]) -> pa.Table:
    table = pa.Table.from_batches([made]).append_column("kind", pa.array([kind] * made.num_rows, pa.int32()))
    return table.append_column("rests", pa.array(rests, pa.binary()))


def answers(counts: DataFrame, bits: int) -> DataFrame:
    """What the parts know: for words and pairs a row per block, its facts in the order of the block's keys;
    for byte strings one row with their numbers and counts. One row of a part of words has its sums."""

    def answer(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        kind = rows.column("kind")[0].as_py()
        told = [read_counts(c) for c in rows.column("counts").to_pylist()]
        if kind == PAIR:
            packs = zip(rows.column("keys").to_pylist(), rows.column("rests").to_pylist(), strict=True)
            every, place = Wide.joined([Wide.unpacked(k, r, _rest_bytes(bits)) for k, r in packs]).distinct()
            sums = np.bincount(place, weights=np.concatenate(told), minlength=len(every.high)).astype(np.int64)
            places = np.split(place, np.cumsum([len(n) for n in told])[:-1])
        else:
            keys = [keys_of(k) for k in rows.column("keys").to_pylist()]
            every, sums = summed(keys, told)
        out = {k: [] for k in ("block", "totals", "contexts", "others", "gains")}
        facts = [0, 0, 0, 0.0]
        if kind == STRING:
            strings = every * np.uint64(pow(_BASE, -1, 1 << 64))
            out = {"block": [-1], "totals": [small_counts(sums)], "contexts": [strings.tobytes()], "others": [None], "gains": [None]}
        else:
            if kind == WORD:
                some = sums[sums > 0].astype(float)
                facts = [int(sums.sum()), len(some), int((sums == 1).sum()), float((some * np.log(some)).sum())]
                context = kinds = entropy = None
                places = (np.searchsorted(every, k) for k in keys)
            else:
                context, kinds, entropy = _contexts(every.high, sums, bits)
            for block, at in zip(rows.column("block").to_pylist(), places, strict=True):
                out["block"].append(block)
                if context is None:
                    out["totals"].append(small_counts(sums[at]))
                    for c in ("contexts", "others", "gains"):
                        out[c].append(None)
                    continue
                # A context met once, or always with another token, is never retained.
                live = kinds[at] < context[at]
                out["totals"].append(small_counts(np.where(live, sums[at], 0)))
                out["contexts"].append(small_counts(np.where(live, context[at], 0)))
                out["others"].append(small_counts(np.where(live, kinds[at], 0)))
                out["gains"].append(zstandard.compress(np.where(live, entropy[at], 0).astype(np.float32).tobytes(), 1))
        n = len(out["block"])
        extra = {name: pa.array([f] + [0] * (n - 1), pa.float64() if name == "clogc" else pa.int64()) for name, f in zip(("n", "v", "once", "clogc"), facts, strict=True)}
        made = {"kind": pa.array([kind] * n, pa.int32()), "part": pa.array([rows.column("part")[0].as_py()] * n, pa.int32()), "block": pa.array(out["block"], pa.int64())}
        made |= {c: pa.array(out[c], pa.binary()) for c in ("totals", "contexts", "others", "gains")} | extra
        return pa.table(made)

    schema = "kind int, part int, block bigint, totals binary, contexts binary, others binary, gains binary, n bigint, v bigint, once bigint, clogc double"
    return counts.groupBy("kind", "part").applyInArrow(answer, schema)


def _contexts(every: np.ndarray, sums: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair, by its first word: its context's count, number of different next tokens, and count times entropy."""
    context = every >> np.uint64(64 - bits)
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    size = np.diff(np.r_[first, len(every)])
    total = np.add.reduceat(sums, first)
    kinds = np.add.reduceat((sums > 0).astype(np.int64), first)
    each = sums * np.log(np.maximum(sums, 1))
    entropy = total * np.log(np.maximum(total, 1)) - np.add.reduceat(each, first)
    return np.repeat(total, size), np.repeat(kinds, size), np.repeat(entropy, size)


def byte_strings(answered: DataFrame) -> DataFrame:
    """(string, n): byte strings of CONTEXT + 1 bytes, as numbers, with their counts over all blocks."""

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["contexts"], np.int64)), pa.array(read_counts(row["totals"]))], names=["string", "n"])

    return answered.where(F.col("kind") == STRING).select("totals", "contexts").mapInArrow(unpack, "string bigint, n bigint")


def _low_bytes(n):
    """A mask of the lowest n bytes."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (n * 8).cast("int")) - 1


def retained_contexts(strings: DataFrame) -> DataFrame:
    """(length, context, next, n): next-byte counts of the contexts that pass both tests, and of the empty one."""
    by_length = strings.select(F.explode(F.sequence(F.lit(0), F.lit(CONTEXT))).alias("length"), "string", "n")
    mask = _low_bytes(F.col("length"))
    grouped = by_length.select(
        "length", F.shiftright("string", 8).bitwiseAND(mask).alias("context"), F.col("string").bitwiseAND(F.lit(255)).alias("next"), "n"
    )
    counts = stage(grouped.groupBy("length", "context", "next").agg(F.sum("n").alias("n")), "contexts")
    sums = counts.groupBy("length", "context").agg(F.sum("n").alias("total"))
    whole = sums.where("length = 0").first()
    frequent = sums.where(F.col("total") >= LEAST_SHARE * (whole["total"] if whole else 0))
    # At most (CONTEXT + 1) / LEAST_SHARE contexts by the test just made: a proven bound.
    own = counts.join(F.broadcast(frequent), ["length", "context"])
    parent_mask = _low_bytes(F.col("length") - 1)
    child = own.where("length > 0").withColumn("shorter", F.col("context").bitwiseAND(parent_mask))
    parent = own.select((F.col("length") + 1).alias("length"), F.col("context").alias("shorter"), "next", F.col("n").alias("pn"), F.col("total").alias("pt"))
    terms = child.join(parent, ["length", "shorter", "next"])
    gain = F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("pn") / F.col("pt")))
    kept = terms.groupBy("length", "context").agg(F.sum(gain).alias("gain")).where(F.col("gain") >= DIVERGENCE).select("length", "context")
    # The suffixes of a retained context belong to the tree with it.
    suffixes = kept.select(F.explode(F.sequence(F.lit(0), "length")).alias("l"), "context").select(
        F.col("l").alias("length"), F.col("context").bitwiseAND(_low_bytes(F.col("l"))).alias("context")
    )
    tree = suffixes.unionByName(sums.where("length = 0").select("length", "context")).distinct()
    return counts.join(F.broadcast(tree), ["length", "context"]).select("length", "context", "next", "n")


class Automaton:
    """Next states and log probabilities of a suffix tree, for all states and bytes."""

    def __init__(self, lengths: np.ndarray, contexts: np.ndarray, nexts: np.ndarray, counts: np.ndarray):
        tree: dict[tuple[int, int], np.ndarray] = {(0, 0): np.zeros(256)}
        for length, context, b, n in zip(lengths.tolist(), contexts.tolist(), nexts.tolist(), counts.tolist(), strict=True):
            tree.setdefault((length, context), np.zeros(256))[b] += n
        # Beginnings of contexts are states too, else a context could not be reached byte by byte.
        states = {(k, c >> 8 * (length - k)) for length, c in tree for k in range(length + 1)}
        states |= {(k, c & (1 << 8 * k) - 1) for length, c in states for k in range(length + 1)}
        order = sorted(states)
        number = {s: i for i, s in enumerate(order)}
        dist = np.empty((len(order), 256))
        self.next = np.zeros((len(order), 256), np.int32)
        for i, (length, context) in enumerate(order):
            shorter = np.full(256, 1 / 256) if not length else dist[number[length - 1, context & (1 << 8 * (length - 1)) - 1]]
            own = tree.get((length, context))
            dist[i] = shorter if own is None else (own + SMOOTHING * shorter) / (own.sum() + SMOOTHING)
        arrays = {k: (np.array([c for n, c in order if n == k], np.int64), np.array([number[s] for s in order if s[0] == k])) for k in range(CONTEXT + 1)}
        values = np.array([c for _, c in order], np.int64)[:, None] << 8 | np.arange(256)
        size = np.array([n for n, _ in order])[:, None] + 1
        for k in range(1, CONTEXT + 1):
            known, numbers = arrays[k]
            if len(known):
                v = values & ((1 << 8 * k) - 1)
                at = np.minimum(np.searchsorted(known, v), len(known) - 1)
                self.next = np.where((known[at] == v) & (size >= k), numbers[at], self.next).astype(np.int32)
        self.log = np.log(dist).astype(np.float32).ravel()
        self.next = (self.next.astype(np.int64) << 8).astype(np.int32).ravel()

    def byte_logs(self, stream: np.ndarray) -> np.ndarray:
        """Log probability of every byte of a stream, from at most CONTEXT bytes before it."""
        lanes = min(_LANES, max(1, len(stream) // 64))
        width = -(-len(stream) // lanes)
        # Lane k reads its stretch and, to find its state, the CONTEXT bytes before.
        source = np.full(width * lanes + CONTEXT, END[0], np.uint8)
        source[CONTEXT : CONTEXT + len(stream)] = stream
        view = np.lib.stride_tricks.as_strided(source, (lanes, width + CONTEXT), (width, 1))
        steps = np.ascontiguousarray(view.T)
        out = np.empty((width, lanes), np.float32)
        state = np.zeros(lanes, np.int32)
        for t in range(width + CONTEXT):
            at = state | steps[t]
            if t >= CONTEXT:
                np.take(self.log, at, out=out[t - CONTEXT])
            state = np.take(self.next, at)
        return out.T.ravel()[: len(stream)]


@lru_cache(maxsize=1)
def _automaton(*parts: bytes) -> Automaton:
    return Automaton(*(np.frombuffer(p, np.int64) for p in parts))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 10) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score and, without word contexts, alone_score and spelled_score (log10).

    Documents whose crc32(id as text) modulo ``held_out_mod`` is 0 are held out of all counts.
    ``docs`` is read twice and must give each task the same rows both times, as files do: blocks
    are what a task reads, so that texts are shuffled once, for the second pass only.
    """
    steady_splits(docs.sparkSession)
    size, parts_wanted = blocks_for(docs, text_col)
    bits = min(63, SPARE_BITS + max(22, size.bit_length()))
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string").cast("binary"))
    answered = stage(answers(block_counts(rows, parts_wanted, bits, held_out_mod), bits), "tree-answers")
    sums = answered.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n", "v", "once", "clogc")]).first()
    n, v = sums["n"], sums["v"]
    # Entropy of a token without context.
    entropy = log(n) - sums["clogc"] / n if n else 0.0
    tree = retained_contexts(byte_strings(answered)).toPandas()
    parts = [tree[k].to_numpy(np.int64).tobytes() for k in ("length", "context", "next", "n")]
    spelling = min(0.5, max(1e-3, sums["once"] / n)) if n else 1.0

    def score(key, packs: pa.Table, told: pa.Table) -> pa.Table:
        automaton = _automaton(*parts)
        held = list(held_chunks(packs, held_out_mod, bits))
        told = told.sort_by([("kind", "ascending"), ("part", "ascending")]).to_pylist()
        # The block's words and pairs in the order in which they were dealt.
        word, total = _told(told, WORD, [c.keys for c in held], "totals")
        pair, seen, met, kinds, spread = _told(told, PAIR, [c.pairs for c in held], "totals", "contexts", "others", "gains")
        retained = (met > 0) & (met * entropy - spread > kinds * entropy)
        offset = np.cumsum([0, *(len(c.keys) for c in held)])
        out = []
        for c, lo, hi in zip(held, offset[:-1], offset[1:], strict=True):
            count = total[word[lo:hi]]
            base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
            stream, place = c.padded()
            spelled = np.add.reduceat(automaton.byte_logs(stream)[place].astype(np.float64), c.token_start)
            alone = np.logaddexp(log(spelling) + spelled, np.log(np.maximum(count, 1e-300)) + log(max(1 - spelling, 1e-300)) - log(max(n, 1)))
            at = pair[lo:hi]
            k, m = kinds[at], met[at]
            within = np.logaddexp(np.log(np.maximum(seen[at], 1e-300)), np.log(np.maximum(k, 1)) + alone) - np.log(np.maximum(m + k, 1))
            best = np.where(retained[at], within, alone)
            columns = [
                pa.array(c.ids, pa.int64(), mask=c.nulls),
                pa.array(~c.train),
                pa.array(c.tokens.astype(np.int64)),
                pa.array(c.per_doc((count > 0).astype(np.int64))),
                pa.array(np.full(len(c.ids), n, np.int64)),
                *(pa.array(c.per_doc(x)) for x in (base, best / log(10), alone / log(10), spelled / log(10))),
            ]
            out.append(pa.table(columns, names=["id", *SCORES]))
        return pa.concat_tables(out)

    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, alone_score double, spelled_score double"
    to_blocks = answered.where(F.col("kind") != STRING).select("block", "kind", "part", "totals", "contexts", "others", "gains")
    made = task_packs(rows, spelled_bytes).groupBy("block").cogroup(to_blocks.groupBy("block")).applyInArrow(score, schema)
    return made.withColumnRenamed("id", id_col)


SCORES = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "alone_score", "spelled_score")


def _told(rows: list[dict], kind: int, keys: list[np.ndarray] | list[Wide], *columns: str) -> list[np.ndarray]:
    """For each token of a block the place of its key among the distinct ones, sorted, and what
    the parts told about these."""
    if kind == PAIR:
        every, place = Wide.joined(keys).distinct()
        every = every.high
    else:
        every, place = np.unique(np.concatenate(keys), return_inverse=True)
    out = [place]
    for c in columns:
        values = [np.frombuffer(zstandard.decompress(r[c]), np.float32) if c == "gains" else read_counts(r[c]) for r in rows if r["kind"] == kind]
        out.append(np.concatenate(values).astype(np.float64))
        if len(out[-1]) != len(every):
            raise ValueError("the documents were not read twice alike: a block's keys and the answers do not match")
    return out


@query("op2_suffix_tree")
def op2_suffix_tree(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
