"""Repeated passages removed: byte strings of a least length that an earlier document holds too.

Every window of ``min_bytes`` bytes has a key, the least hash of the shorter strings in it, so
that equal windows have equal keys and neighbouring windows mostly share one. Three passes over
blocks of documents, each packed and compressed:

1. The blocks deal the distinct keys of their windows to parts of the key space, which answer
   which keys occur in two documents or more. Other windows cannot be repeated.
2. The blocks send the stretches of bytes whose windows have a repeated key, each different
   stretch once with its smallest document. A part indexes its stretches: a Burrows-Wheeler
   transform restricted to the suffixes that can still become a window. Its intervals are
   expanded breadth-first by backward extension, one byte at a time from length 0 up to
   ``min_bytes``: a stable sort by the byte before each suffix is the step of the transform, and
   an interval splits where the byte or the interval before differs. Intervals of one suffix are
   settled and leave; what is left at the last length are the sets of equal windows, the search
   stops there, and every set gets its smallest document.
3. The blocks read the answers and remove each byte of a window whose smallest document is
   smaller than their own.

Copies in a block collapse before they are sent, copies across blocks before they are indexed,
so that a group of any size costs a task one stretch per block.

Defined results: NULL and empty texts have no bytes and no spans; documents without id remove
nothing and lose nothing; rows that repeat an id do not remove each other; matches never cross
documents; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import Hashes, blocks_for, chunks, dealt, distinct, keys_of, packed, part_of, read_counts, scrambled, small_counts, small_keys, summed
from tidemark.llm.common import query, stage, table

MIN_BYTES = 50
#: Bytes of the strings whose least hash is a window's key, as a share of the window.
KEY_SHARE = 0.48
#: Bits of a key beyond log2 of the corpus in the first exchange.
SPARE_BITS = 12
OUTPUTS = {
    "n_bytes": ("bigint", pa.int64()),
    "n_removed": ("bigint", pa.int64()),
    "n_spans": ("bigint", pa.int64()),
    "spans": ("array<array<bigint>>", pa.list_(pa.list_(pa.int64()))),
    "kept": ("binary", pa.binary()),
    "kept_sha256": ("string", pa.string()),
}


class Runs:
    """Runs of windows with one key in some documents: keys, first and last-plus-one window, document, hash."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, data: bytes, least: int):
        self.ids, self.nulls, self.sizes = ids, nulls, sizes
        self.bytes = np.frombuffer(data, np.uint8)
        ends = np.cumsum(sizes)
        self.doc_start = ends - sizes
        width = max(1, int(least * KEY_SHARE))
        if len(data) < least:
            self.key = self.mark = np.zeros(0, np.uint64)
            self.start = self.stop = self.doc = np.zeros(0, np.int64)
            return
        hashes = Hashes(self.bytes)
        key = hashes.width(width)
        span, reach = least - width + 1, 1
        while reach * 2 <= span:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if span > reach:
            key = np.minimum(key[: len(key) - (span - reach)], key[span - reach :])
        # Windows that cross a document's end are none; they also part the runs of two documents.
        inside = np.ones(len(key), bool)
        cross = (ends[:, None] - np.arange(1, least)).ravel()
        inside[cross[(cross >= 0) & (cross < len(key))]] = False
        cut = np.flatnonzero((key[1:] != key[:-1]) | (inside[1:] != inside[:-1])) + 1
        cut = np.r_[0, cut]
        stop = np.r_[cut[1:], len(key)]
        doc = np.searchsorted(ends, cut, "right")
        usable = inside[cut] & ~nulls[doc]
        self.start, self.stop, self.doc = cut[usable], stop[usable], doc[usable]
        # Least hashes are small numbers; spread, they deal the parts evenly.
        self.key = scrambled(key[self.start])
        self.mark = hashes.of(self.start, self.stop + least - 1)


def _block_runs(rows: pa.Table, least: int) -> list[Runs]:
    return [Runs(*c, least) for c in chunks(rows)]


def _deal_keys(packs: DataFrame, parts: int, bits: int, least: int) -> DataFrame:
    """Distinct keys of every block, counted 1, or 2 if two of its documents have them."""

    def deal(rows: pa.Table) -> pa.Table:
        keys, low, high = [], [], []
        for r in (Runs(*c, least) for c in chunks(rows)):
            k, lo, hi = _bounds(r.key >> np.uint64(64 - bits) << np.uint64(64 - bits), r.ids[r.doc], r.ids[r.doc])
            keys.append(k), low.append(lo), high.append(hi)
        k, lo, hi = _bounds(*(np.concatenate(x) for x in (keys, low, high)))
        return pa.Table.from_batches([dealt(rows.column("block")[0].as_py(), k, 1 + (hi > lo), parts)])

    return packs.groupBy("block").applyInArrow(deal, "part int, block int, keys binary, counts binary")


def _bounds(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the least of ``low`` and the greatest of ``high``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, low, high
    return keys[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _repeated_keys(keys: DataFrame) -> DataFrame:
    """(block, part, repeated): a bit for every key of a block, in the block's order."""

    def judge(rows: pa.Table) -> pa.Table:
        own = [keys_of(k) for k in rows.column("keys").to_pylist()]
        every, sums = summed(own, [read_counts(c) for c in rows.column("counts").to_pylist()])
        bits = [np.packbits(sums[np.searchsorted(every, k)] > 1).tobytes() for k in own]
        sizes = [len(k) for k in own]
        return pa.table([rows.column("block"), rows.column("part"), pa.array(bits, pa.binary()), pa.array(sizes, pa.int64())], names=["block", "part", "repeated", "size"])

    return keys.groupBy("part").applyInArrow(judge, "block int, part int, repeated binary, size bigint")


def _repeated_runs(runs: list[Runs], told: pa.Table, bits: int) -> list[np.ndarray]:
    """For each chunk of a block, the places of its runs with a repeated key."""
    short = [r.key >> np.uint64(64 - bits) << np.uint64(64 - bits) for r in runs]
    every = distinct(np.concatenate(short)) if short else np.zeros(0, np.uint64)
    told = told.sort_by("part").to_pylist()
    flags = [np.unpackbits(np.frombuffer(t["repeated"], np.uint8), count=t["size"]).astype(bool) for t in told]
    flag = np.concatenate(flags) if flags else np.zeros(0, bool)
    if len(flag) != len(every):
        raise ValueError("a block's keys and the answers do not match")
    return [np.flatnonzero(flag[np.searchsorted(every, s)]) if len(s) else np.zeros(0, np.int64) for s in short]


def _stretches(runs: list[Runs], places: list[np.ndarray]):
    """The different stretches of a block's repeated runs, sorted by key and hash.

    Returns their keys, chunk and place of one run for each, smallest document, and for every
    chunk the stretch of each of its repeated runs.
    """
    key = np.concatenate([r.key[p] for r, p in zip(runs, places, strict=True)])
    mark = np.concatenate([r.mark[p] for r, p in zip(runs, places, strict=True)])
    size = np.concatenate([r.stop[p] - r.start[p] for r, p in zip(runs, places, strict=True)])
    doc = np.concatenate([r.ids[r.doc[p]] for r, p in zip(runs, places, strict=True)])
    order = np.lexsort((size, mark, key))
    k, m, s = key[order], mark[order], size[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (s[1:] != s[:-1])][: len(k)]
    first = np.flatnonzero(new)
    smallest = np.minimum.reduceat(doc[order], first) if len(first) else doc
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return k[first], order[first], smallest, number, s[first]


SENT = "part int, block int, keys binary, sizes binary, docs binary, data binary"


def _send_stretches(packs: DataFrame, told: DataFrame, parts: int, bits: int, least: int) -> DataFrame:
    """Every different stretch of a block once, dealt to the parts by its key."""

    def send(_, rows: pa.Table, told: pa.Table) -> pa.Table:
        runs = _block_runs(rows, least)
        places = _repeated_runs(runs, told, bits)
        key, where, smallest, _, size = _stretches(runs, places)
        data = np.concatenate([r.bytes for r in runs])
        before = np.cumsum([0, *(len(r.bytes) for r in runs)])
        start = np.concatenate([r.start[p] + b for r, p, b in zip(runs, places, before[:-1], strict=True)])[where]
        length = size + least - 1
        part = part_of(key, parts)
        used, starts = np.unique(part, return_index=True)
        out: dict[str, list] = {k: [] for k in ("part", "block", "keys", "sizes", "docs", "data")}
        block = rows.column("block")[0].as_py()
        for p, lo, hi in zip(used.tolist(), starts.tolist(), [*starts.tolist(), len(key)][1:], strict=True):
            many = length[lo:hi]
            at = np.repeat(start[lo:hi] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            out["part"].append(p)
            out["block"].append(block)
            out["keys"].append(small_keys(key[lo:hi]))
            out["sizes"].append(small_counts(size[lo:hi]))
            out["docs"].append(zstandard.compress(smallest[lo:hi].tobytes(), 1))
            out["data"].append(zstandard.compress(data[at].tobytes(), 3))
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    return packs.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send, SENT)


def equal_windows(data: np.ndarray, start: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
    """Sets of equal windows by backward extension: one number per window, equal for equal ones.

    Stretch i has ``count[i]`` windows, the first at ``start[i]``. Windows alone in their set get
    a number of their own, from -1 downwards.
    """
    total = int(count.sum())
    result = -1 - np.arange(total)
    # Suffixes in the order of their next bytes up to the window's end, and their intervals.
    row = np.arange(total, dtype=np.int32 if total < 1 << 31 else np.int64)
    interval = np.zeros(total, row.dtype)
    at = np.repeat((start + least - np.cumsum(count) + count).astype(np.int64), count) + row
    for _ in range(least):
        at = at - 1
        byte = data[at]
        order = np.argsort(byte, kind="stable")
        byte, interval, at, row = byte[order], interval[order], at[order], row[order]
        new = np.r_[True, (byte[1:] != byte[:-1]) | (interval[1:] != interval[:-1])] if len(row) else np.zeros(0, bool)
        alone = new & np.r_[new[1:], True] if len(row) else new
        interval = np.cumsum(new, dtype=row.dtype)
        if alone.any():
            at, row, interval = at[~alone], row[~alone], interval[~alone]
        if not len(row):
            break
    result[row] = interval
    return result


def _marks(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of stretches that lie one behind the other, about a megabyte at a time."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(stop, start[lo] + 1_000_000)))
        out[lo:hi] = Hashes(data[start[lo] : stop[hi - 1]]).of(start[lo:hi] - start[lo], stop[lo:hi] - start[lo])
        lo = hi
    return out


def _index_stretches(sent: DataFrame, least: int) -> DataFrame:
    """(block, part, smallest): for every window of a block's stretches the smallest document that has it."""

    def index(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        sizes = [read_counts(s) for s in rows.column("sizes").to_pylist()]
        docs = np.concatenate([np.frombuffer(zstandard.decompress(d), np.int64) for d in rows.column("docs").to_pylist()])
        data = np.frombuffer(b"".join([zstandard.decompress(d) for d in rows.column("data").to_pylist()]), np.uint8)
        windows = np.concatenate(sizes)
        stop = np.cumsum(windows + least - 1)
        start = stop - (windows + least - 1)
        # Copies sent by several blocks are indexed once.
        mark = _marks(data, start, stop)
        order = np.lexsort((windows, mark))
        m, w = mark[order], windows[order]
        new = np.r_[True, (m[1:] != m[:-1]) | (w[1:] != w[:-1])]
        first = np.flatnonzero(new)
        smallest = np.minimum.reduceat(docs[order], first)
        copy = np.empty(len(order), np.int64)
        copy[order] = np.cumsum(new) - 1
        count = w[first]
        sets = equal_windows(data, start[order[first]], count, least)
        best = np.repeat(smallest, count)
        together = np.flatnonzero(sets >= 0)
        if len(together):
            least_of = np.full(int(sets.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least_of, sets[together], best[together])
            best[together] = least_of[sets[together]]
        begin = np.cumsum(count) - count
        made, lo = [], 0
        for s in sizes:
            own = copy[lo : lo + len(s)]
            lo += len(s)
            where = np.repeat(begin[own] - (np.cumsum(s) - s), s) + np.arange(int(s.sum()))
            made.append(zstandard.compress(best[where].tobytes(), 3))
        return pa.table([rows.column("block"), rows.column("part"), pa.array(made, pa.binary())], names=["block", "part", "smallest"])

    return sent.groupBy("part").applyInArrow(index, "block int, part int, smallest binary")


def remove_repeats(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    outputs: tuple[str, ...] = ("n_bytes", "spans", "kept"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: the id and the ``outputs`` asked for, among the spans (start, end) of bytes removed and the bytes kept."""
    least = min_bytes
    size, blocks = blocks_for(docs, text_col)
    bits = min(64, SPARE_BITS + max(20, size.bit_length()))
    # Packs are made again for every pass: cheaper than to store them.
    packs = packed(docs, blocks, bytes, id_col, text_col)
    told = stage(_repeated_keys(_deal_keys(packs, blocks, bits, least)), "repeat-keys")
    answered = stage(_index_stretches(_send_stretches(packs, told, blocks, bits, least), least), "repeat-windows")
    # Both answers in one table, so that a block meets them in one group.
    both = told.withColumn("smallest", F.lit(None).cast("binary")).unionByName(answered, allowMissingColumns=True)

    def remove(_, rows: pa.Table, both: pa.Table) -> pa.Table:
        is_key = np.array([s is not None for s in both.column("size").to_pylist()], bool)
        runs = _block_runs(rows, least)
        places = _repeated_runs(runs, both.filter(pa.array(is_key)), bits)
        _, _, _, number, size = _stretches(runs, places)
        known = both.filter(pa.array(~is_key)).sort_by("part").column("smallest").to_pylist()
        smallest = np.concatenate([np.frombuffer(zstandard.decompress(k), np.int64) for k in known]) if known else np.zeros(0, np.int64)
        if len(smallest) != int(size.sum()):
            raise ValueError("a block's windows and the answers do not match")
        begin = np.cumsum(size) - size
        out: dict[str, list] = {k: [] for k in outputs}
        ids, offset = [], 0
        for r, p in zip(runs, places, strict=True):
            own = number[offset : offset + len(p)]
            offset += len(p)
            covered = _covered(r, p, begin[own], smallest, least)
            for i in range(len(r.ids)):
                ids.append(None if r.nulls[i] else int(r.ids[i]))
                lo = int(r.doc_start[i])
                _describe(out, r.bytes[lo : lo + int(r.sizes[i])], covered[lo : lo + int(r.sizes[i])])
        return pa.table([pa.array(ids, pa.int64()), *(pa.array(v, OUTPUTS[k][1]) for k, v in out.items())], names=["id", *outputs])

    schema = "id bigint, " + ", ".join(f"{k} {OUTPUTS[k][0]}" for k in outputs)
    made = packs.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(remove, schema)
    return made.withColumnRenamed("id", id_col)


def _covered(r: Runs, places: np.ndarray, begin: np.ndarray, smallest: np.ndarray, least: int) -> np.ndarray:
    """Which bytes of a chunk lie in a window that a smaller document has."""
    count = r.stop[places] - r.start[places]
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    earlier = smallest[np.repeat(begin, count) + step] < np.repeat(r.ids[r.doc[places]], count)
    window = (np.repeat(r.start[places], count) + step)[earlier]
    change = np.zeros(len(r.bytes) + 1, np.int32)
    np.add.at(change, window, 1)
    np.add.at(change, window + least, -1)
    return np.cumsum(change[:-1]) > 0


def _describe(out: dict[str, list], data: np.ndarray, covered: np.ndarray) -> None:
    edge = np.flatnonzero(np.diff(np.r_[False, covered, False]))
    kept = data[~covered].tobytes() if "kept" in out or "kept_sha256" in out else b""
    values = {
        "n_bytes": len(data),
        "n_removed": int(covered.sum()),
        "n_spans": len(edge) // 2,
        "spans": edge.reshape(-1, 2).tolist() if "spans" in out else None,
        "kept": kept,
        "kept_sha256": hashlib.sha256(kept).hexdigest() if "kept_sha256" in out else None,
    }
    for k, v in out.items():
        v.append(values[k])


@query("op5_repeated_text")
def op5_repeated_text(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))
