"""Texts in blocks of bounded size, and exchanges of packed key counts between blocks.

Some operators need, for all distinct keys of a block of documents, a fact about the key over
the whole corpus. Rows per key would cost many times the text. Here a block deals its sorted
keys to parts of the key space, packed in one row per block and part; the part answers with
one value per key in the same order, again packed. Blocks and parts grow in number with the
data and not in size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 8_000_000
#: Bytes of a block that are worked on at a time.
CHUNK_BYTES = 1_000_000
_BASE = 0x9E3779B97F4A7C15
PACKED = pa.schema([("block", pa.int32()), *((k, pa.binary()) for k in ("ids", "nulls", "sizes", "data"))])
DEALT = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def blocks_for(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Bytes of all texts, and the number of blocks for them."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return size, max(1, -(-size // BLOCK_BYTES))


def packed(docs: DataFrame, blocks: int, encode: Callable[[bytes], bytes], id_col: str, text_col: str) -> DataFrame:
    """Documents dealt to blocks by id, encoded, packed and compressed before they are shuffled."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, block, texts = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2)
            order = np.argsort(block, kind="stable")
            out: dict[str, list] = {k: [] for k in PACKED.names}
            for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []:
                data = [encode(texts[i].as_py() or b"") for i in rows.tolist()]
                own = [ids[i] for i in rows.tolist()]
                out["block"].append(int(block[rows[0]]))
                out["ids"].append(np.array([i or 0 for i in own], np.int64).tobytes())
                out["nulls"].append(np.array([i is None for i in own], np.uint8).tobytes())
                out["sizes"].append(np.array([len(d) for d in data], np.int64).tobytes())
                out["data"].append(press.compress(b"".join(data)))
            yield pa.RecordBatch.from_pydict(out, PACKED)

    # Rows without id are dealt by their text, so that they do not meet in one block.
    key = F.xxhash64(id_col, F.when(F.col(id_col).isNull(), F.xxhash64(text_col)))
    block = F.pmod(key, F.lit(blocks)).cast("int")
    picked = docs.select(F.col(id_col).cast("bigint"), block, F.col(text_col).cast("string").cast("binary"))
    return picked.mapInArrow(pack, "block int, ids binary, nulls binary, sizes binary, data binary")


def task_blocks(batches: Iterator[pa.RecordBatch], encode: Callable[[bytes], bytes]) -> Iterator[tuple]:
    """(block, ids, nulls, sizes, data) of a task's rows (id, text) as they come, some megabytes a block.

    Blocks are numbered by task and place, so that a task that is run again, or another job that
    reads the same files, makes the same blocks: nothing need be shuffled to make them.
    """
    task = TaskContext.get().partitionId() << 32
    made, ids, data, size = 0, [], [], 0

    def block() -> tuple:
        own = np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.bool_)
        return (task + made, *own, np.array([len(d) for d in data], np.int64), b"".join(data))

    for batch in batches:
        texts = batch.column(1)
        for at, i in enumerate(batch.column(0).to_pylist()):
            ids.append(i)
            data.append(encode(texts[at].as_py() or b""))
            size += len(data[-1])
            if size >= BLOCK_BYTES:
                yield block()
                made, ids, data, size = made + 1, [], [], 0
    if ids:
        yield block()


def steady_splits(spark: SparkSession) -> None:
    """Keep this session's scans from cutting files anew when executors come or go.

    Spark cuts small inputs by the number of cores it has at that moment; blocks that are made
    twice must be cut alike, also if an executor is lost in between.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def task_packs(docs: DataFrame, encode: Callable[[bytes], bytes]) -> DataFrame:
    """The ``task_blocks`` of (id, text) rows, packed and compressed, one row each."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for block, ids, nulls, sizes, data in task_blocks(batches, encode):
            row = {"block": [block], "ids": [ids.tobytes()], "nulls": [nulls.tobytes()], "sizes": [sizes.tobytes()], "data": [press.compress(data)]}
            yield pa.RecordBatch.from_pydict(row, PACKED.set(0, pa.field("block", pa.int64())))

    return docs.mapInArrow(pack, "block bigint, ids binary, nulls binary, sizes binary, data binary")


def chunks(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(ids, nulls, sizes, data) of a block's documents, some megabytes at a time."""
    press = zstandard.ZstdDecompressor()
    for row in rows.select(["ids", "nulls", "sizes", "data"]).to_pylist():
        data = press.decompress(row["data"]) if row["data"] else b""
        yield from cut(*(np.frombuffer(row[k], t) for k, t in (("ids", np.int64), ("nulls", np.bool_), ("sizes", np.int64))), data)


def cut(ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Documents, some megabytes at a time."""
    start = byte = 0
    while start < len(ids):
        stop = start + 1 + int(np.searchsorted(np.cumsum(sizes[start + 1 :]), CHUNK_BYTES - sizes[start], "right"))
        length = int(sizes[start:stop].sum())
        yield ids[start:stop], nulls[start:stop], sizes[start:stop], data[byte : byte + length]
        start, byte = stop, byte + length


class Hashes:
    """64-bit polynomial hashes of any stretches of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        forward, self.backward = _powers(len(data) + 1)
        self.run = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:-1], dtype=np.uint64)]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return scrambled((self.run[stop] - self.run[start]) * self.backward[start])

    def width(self, n: int) -> np.ndarray:
        """Of the n bytes from every place on."""
        return scrambled((self.run[n:] - self.run[:-n]) * self.backward[: len(self.run) - n])


def scrambled(h: np.ndarray) -> np.ndarray:
    """Numbers spread evenly over 64 bits, one to one."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _all_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.empty(n, np.uint64)
        powers[0] = 1
        done = 1
        while done < n:
            powers[done : 2 * done] = powers[: min(done, n - done)] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        out.append(powers)
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    f, b = _all_powers(1 << max(20, (n - 1).bit_length()))
    return f[:n], b[:n]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Equal stretches of the 64-bit key space."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def small_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest width that holds them, compressed."""
    top = int(counts.max()) if len(counts) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + zstandard.compress(counts.astype(kind).tobytes(), 1)


def read_counts(data: bytes) -> np.ndarray:
    kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}
    return np.frombuffer(zstandard.decompress(data[1:]), kinds[data[0]]).astype(np.int64)


def small_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes one behind the other, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def keys_of(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def dealt(block: int, keys: np.ndarray, counts: np.ndarray, parts: int, schema: pa.Schema = DEALT) -> pa.RecordBatch:
    """Sorted distinct keys of a block with their counts, one row per part that gets some."""
    part = part_of(keys, parts)
    out: dict[str, list] = {k: [] for k in DEALT.names}
    used, starts = np.unique(part, return_index=True)
    for p, lo, hi in zip(used.tolist(), starts.tolist(), [*starts.tolist(), len(keys)][1:], strict=True):
        out["part"].append(p)
        out["block"].append(block)
        out["keys"].append(small_keys(keys[lo:hi]))
        out["counts"].append(small_counts(counts[lo:hi]))
    return pa.RecordBatch.from_pydict(out, schema)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: for numbers faster than numpy's hash table)."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    every, numbers = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, numbers = every[order], numbers[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(numbers, first) if len(every) else numbers


class Wide:
    """Keys of up to 128 bits in sorted order: a first word that deals them, and the rest."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = high, low

    def order(self) -> np.ndarray:
        """Of any keys. Few keys share their first word, so only those are sorted by both."""
        order = np.argsort(self.high, kind="stable")
        high = self.high[order]
        same = np.r_[False, high[1:] == high[:-1]][: len(high)]
        tied = np.flatnonzero(same | np.r_[same[1:], False][: len(high)])
        if len(tied):
            own = order[tied]
            order[tied] = own[np.lexsort((self.low[own], self.high[own]))]
        return order

    def take(self, at: np.ndarray) -> Wide:
        return Wide(self.high[at], self.low[at])

    def first(self) -> np.ndarray:
        """Places of the distinct ones of sorted keys."""
        if not len(self.high):
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.r_[True, (self.high[1:] != self.high[:-1]) | (self.low[1:] != self.low[:-1])])

    def distinct(self) -> tuple[Wide, np.ndarray]:
        """The distinct keys, sorted, and for each key its place among them."""
        order = self.order()
        every = self.take(order)
        first = every.first()
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        return every.take(first), place

    def packed(self, width: int) -> bytes:
        """The second words of some keys in their lowest ``width`` bytes."""
        return np.ascontiguousarray(self.low.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()

    @staticmethod
    def unpacked(keys: bytes, low: bytes, width: int) -> Wide:
        high = keys_of(keys)
        planes = np.zeros((len(high), 8), np.uint8)
        planes[:, :width] = np.frombuffer(low, np.uint8).reshape(width, len(high)).T
        return Wide(high, planes.view(np.uint64).ravel())

    @staticmethod
    def joined(keys: list[Wide]) -> Wide:
        return Wide(np.concatenate([k.high for k in keys]), np.concatenate([k.low for k in keys]))
