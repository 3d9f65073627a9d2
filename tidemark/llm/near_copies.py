"""Near-duplicate documents by chosen paths over minwise tokens.

A document's set is its distinct shingles of five words (hashed to 64 bits). Equal sets are one
class, represented by its smallest id, so that copies cost one row each however many there are.
Classes are then searched for links:

* Independent trees send every class down a path of minwise tokens: a class's next step is the
  token of its set with the least hash for that tree and level. Two sets of similarity s take
  the same step with probability s, so that twelve trees lose a link of 0.85 at their first
  branching with a probability below 1e-9.
* Small nodes are compared exhaustively by sketches (128 minwise bytes); larger ones branch
  again, unless most of their members are linked to one of them anyway; nodes too large for one
  task branch in Spark, and what never gets small is compared in pairs of chunks.
* A node proposes only the edges of a forest of its likely links, most similar first, and each
  is confirmed on the full sets. Where one fails, the nodes it came from are looked at again: the
  texts of members with a likely link to something that is not connected to them come to the
  node, which confirms link after link until all likely ones are connected or refuted. No list
  of a group's pairs is ever made, and no likely link is left out.

Components are found by alternating stars. Nothing but counts reaches the driver.

Defined results: NULL texts and texts without words have an empty set and link with nothing; a
text of fewer than five words is one shingle; rows without id are compared with nothing, have
no component and are kept; rows that repeat an id are judged by their own text (where such an id represents a class, either text may stand for it); extra columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import distinct
from tidemark.llm.common import fresh, lower_words, per_batch, query, stage, table
from tidemark.llm.components import components
from tidemark.operators.sizing import fits_broadcast

SHINGLE = 5
TREES = 12
SKETCH = 128
#: A node is compared exhaustively up to the first size, within one task up to the second.
SMALL, LARGE = 64, 4096
LEVELS = 8

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes, well mixed (the finalizer of a known generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def likely_bytes(percent: int) -> int:
    """Number of equal sketch bytes from which two sets may be linked: four deviations below the border."""
    p = percent / 100
    return int(SKETCH * (p - 4 * (p * (1 - p) / SKETCH) ** 0.5))


class Hashed(dict):
    """Word -> hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) > 400_000:
            self.clear()
        self[word] = value
        return value


def shingles(text: str, known: Hashed) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += mixed(h[k : k + n] + np.uint64(k)) * _PLACES[k]
    return distinct(mixed(total))


def signature(s: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The first step of every tree, and the sketch of a set."""
    least = np.empty(SKETCH, np.uint64)
    for at in range(0, SKETCH, 16):
        least[at : at + 16] = np.multiply.outer(_FACTORS[at : at + 16], s).min(axis=1)
    steps = mixed(least[:TREES] + np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return steps.view(np.int64), (mixed(least) & np.uint64(255)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, f1, f2, steps, sketch) per row; one narrow pass."""

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = Hashed()
        out: dict[str, list] = {k: [] for k in ("n", "f1", "f2", "steps", "sketch")}
        for text in batch.column(1).to_pylist():
            s = shingles(text or "", known)
            out["n"].append(len(s))
            out["f1"].append(int(s.sum(dtype=np.uint64).view(np.int64)))
            out["f2"].append(int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
            steps, sketch = signature(s) if len(s) else (None, None)
            out["steps"].append(steps)
            out["sketch"].append(sketch)
        types = {"n": pa.int64(), "f1": pa.int64(), "f2": pa.int64(), "steps": pa.list_(pa.int64()), "sketch": pa.binary()}
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, types[k]) for k, v in out.items())], names=["doc", *out])

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(per_batch(signed), "doc bigint, n bigint, f1 bigint, f2 bigint, steps array<bigint>, sketch binary")


def nodes_of(classes: DataFrame) -> DataFrame:
    """(bucket, node, rep, sketch): the members of every node with two at least, branched until they fit a task."""
    steps = classes.select("rep", "sketch", F.posexplode("steps").alias("tree", "node"))
    shared = steps.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    rows = stage(steps.join(shared, "node"), "paths")
    parts = [rows.where(F.col("size") <= LARGE)]
    large = rows.where(F.col("size") > LARGE)
    for level in range(LEVELS):
        if large.isEmpty():
            break
        # Bytes behind those of the first steps, another one for each tree and level.
        place = F.lit(TREES) + F.pmod(F.col("tree") * 29 + level * 13, F.lit(SKETCH - TREES)) + 1
        byte = F.call_function("substring", F.col("sketch"), place, F.lit(1))
        branched = large.withColumn("node", F.xxhash64("node", byte)).drop("size")
        sizes = branched.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        branched = stage(branched.join(sizes, "node"), "paths")
        parts.append(branched.where(F.col("size") <= LARGE))
        large = branched.where(F.col("size") > LARGE)
    else:
        # Members that stay together: every pair of chunks is a node of its own.
        chunks = F.ceil(F.col("size") / (LARGE // 2)).cast("int")
        cut = large.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        pair = F.xxhash64("node", F.least("chunk", "other"), F.greatest("chunk", "other"))
        parts.append(cut.withColumn("node", pair).drop("chunk", "other"))
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p, allowMissingColumns=True)
    return nodes.select("node", "rep", "sketch")


class Forest:
    """Connected groups of positions."""

    def __init__(self, labels: np.ndarray):
        # Positions with one label are connected from the start.
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels.tolist())]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


class Search:
    """Finds likely links among the members of nodes, given as sorted runs of ``node``.

    ``labels`` tells what is connected already. ``found`` is called with a position and those of
    its likely partners that it was not connected to at the start, the most similar first.
    """

    def __init__(self, node: np.ndarray, sketch: np.ndarray, labels: np.ndarray, percent: int, live: bool):
        self.node, self.sketch, self.live = node, sketch, live
        self.percent, self.likely = percent, likely_bytes(percent)
        self.forest = Forest(labels)
        self.at_start = np.array(self.forest.up)

    def found(self, a: int, partners: list[int]) -> None:
        raise NotImplementedError

    def groups(self, m: np.ndarray) -> np.ndarray:
        """What is connected now, or was at the start if links are not followed."""
        return np.array([self.forest.root(x) for x in m.tolist()]) if self.live else self.at_start[m]

    def run(self) -> None:
        tiny: dict[int, list[np.ndarray]] = {}
        rest = []
        for m in np.split(np.arange(len(self.node)), np.flatnonzero(np.diff(self.node)) + 1):
            if 1 < len(m) <= 8:
                tiny.setdefault(len(m), []).append(m)
            elif len(m) > 1:
                rest.append((m, 0))
        self._tiny(tiny)
        while rest:
            m, level = rest.pop()
            if len(m) > SMALL:
                equal = (self.sketch[m[1:]] == self.sketch[m[0]]).sum(axis=1)
                linked = m[1:][equal >= self.likely]
                if 2 * len(linked) < len(m) and level < 40:
                    # Too mixed to compare all: branch by a further minwise token. The branches
                    # may part the first member from its partners, which are told here.
                    apart = linked[self.groups(linked) != self.groups(m[:1])[0]]
                    if len(apart):
                        self.found(int(m[0]), apart.tolist())
                    step = self.sketch[m, TREES + (level * 37 + int(self.node[m[0]] & 63)) % (SKETCH - TREES)]
                    order = np.argsort(step, kind="stable")
                    rest += [(m[p], level + 1) for p in np.split(order, np.flatnonzero(np.diff(step[order])) + 1) if len(p) > 1]
                    continue
            self._all(m)

    def _tiny(self, tiny: dict[int, list[np.ndarray]]) -> None:
        """All nodes of one small size together."""
        pairs = []
        for size, members in tiny.items():
            grid = np.array(members)
            i, j = np.triu_indices(size, 1)
            a, b = grid[:, i].ravel(), grid[:, j].ravel()
            apart = self.at_start[a] != self.at_start[b]
            a, b = a[apart], b[apart]
            for at in range(0, len(a), 50_000):
                x, y = a[at : at + 50_000], b[at : at + 50_000]
                equal = (self.sketch[x] == self.sketch[y]).sum(axis=1)
                keep = equal >= self.likely
                pairs.append(np.stack([equal[keep], x[keep], y[keep]], axis=1))
        if pairs:
            every = np.vstack(pairs)
            for _, a, b in every[np.argsort(-every[:, 0], kind="stable")].tolist():
                self.found(a, [b])

    def _all(self, m: np.ndarray) -> None:
        """Exhaustive comparison of one node; members already connected are passed over."""
        group = self.groups(m)
        for k in range(len(m) - 1):
            ahead = np.flatnonzero(group[k + 1 :] != group[k]) + k + 1
            if not len(ahead):
                if (group[k:] == group[k]).all():
                    break
                continue
            equal = (self.sketch[m[ahead]] == self.sketch[m[k]]).sum(axis=1)
            hits = equal >= self.likely
            if hits.any():
                self.found(int(m[k]), m[ahead[hits]][np.argsort(-equal[hits], kind="stable")].tolist())
                if self.live:
                    group = self.groups(m)


class Propose(Search):
    """A forest of likely links."""

    def __init__(self, node, sketch, labels, percent):
        super().__init__(node, sketch, labels, percent, True)
        self.links: list[tuple[int, int]] = []

    def found(self, a, partners):
        self.links += [(a, b) for b in partners if self.forest.join(a, b)]


class Open(Search):
    """Members with a likely link to something they are not connected to."""

    def __init__(self, node, sketch, labels, percent):
        super().__init__(node, sketch, labels, percent, False)
        self.flags = np.zeros(len(node), bool)

    def found(self, a, partners):
        self.flags[a] = True
        self.flags[partners] = True


class Confirm(Search):
    """A forest of links confirmed on the full sets of the members' texts."""

    def __init__(self, node, sketch, labels, percent, rep, texts):
        super().__init__(node, sketch, labels, percent, True)
        self.rep, self.texts = rep, texts
        self.words, self.sets = Hashed(), {}
        self.links: list[tuple[int, int]] = []

    def _set(self, i: int) -> np.ndarray:
        r = int(self.rep[i])
        if r not in self.sets:
            self.sets[r] = shingles(self.texts[i].as_py(), self.words)
        return self.sets[r]

    def found(self, a, partners):
        for b in partners:
            if self.forest.root(a) != self.forest.root(b) and similar(self._set(a), self._set(b), self.percent):
                self.forest.join(a, b)
                self.links.append((a, b))


def similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(s), len(t)))
    if not least or 100 * least < percent * most:
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def _columns(rows: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    rows = rows.sort_by([("node", "ascending"), ("rep", "ascending")])
    node, rep, label = (rows.column(c).to_numpy() for c in ("node", "rep", "label"))
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
    return rows, [node, sketch, label, rep]


def _link_table(bucket: int, links: list[tuple[int, int]], rep: np.ndarray) -> pa.Table:
    made = sorted({(int(min(rep[a], rep[b])), int(max(rep[a], rep[b]))) for a, b in links})
    return pa.table({"bucket": pa.array([bucket] * len(made), pa.int32()), "a": pa.array([p[0] for p in made], pa.int64()), "b": pa.array([p[1] for p in made], pa.int64())})


NODE = ("bucket", "node", "rep", "label", "sketch")


def propose(nodes: DataFrame, percent: int) -> DataFrame:
    """(bucket, a, b): a forest of likely links of every bucket's nodes."""

    def links(rows: pa.Table) -> pa.Table:
        rows, (node, sketch, label, rep) = _columns(rows)
        search = Propose(node, sketch, label, percent)
        search.run()
        return _link_table(rows.column("bucket")[0].as_py(), search.links, rep)

    return nodes.select(*NODE).groupBy("bucket").applyInArrow(links, "bucket int, a bigint, b bigint")


def still_open(nodes: DataFrame, percent: int) -> DataFrame:
    """The rows of members with a likely link to a set they are not connected to."""

    def flagged(rows: pa.Table) -> pa.Table:
        rows, (node, sketch, label, _) = _columns(rows)
        search = Open(node, sketch, label, percent)
        search.run()
        return rows.select(list(NODE)).filter(pa.array(search.flags))

    return nodes.select(*NODE).groupBy("bucket").applyInArrow(flagged, "bucket int, node bigint, rep bigint, label bigint, sketch binary")


def settle(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(a, b): a forest of the confirmed links of the nodes, compared on full sets where they are."""
    texts = _texts_of(nodes.select("rep"), docs, id_col, text_col)

    def links(rows: pa.Table) -> pa.Table:
        rows, (node, sketch, label, rep) = _columns(rows)
        search = Confirm(node, sketch, label, percent, rep, rows.column("text"))
        search.run()
        return _link_table(rows.column("bucket")[0].as_py(), search.links, rep).select(["a", "b"])

    return nodes.join(texts, "rep").select(*NODE, "text").groupBy("bucket").applyInArrow(links, "a bigint, b bigint")


def _texts_of(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, text) of the ids in ``ids``; rows that repeat an id count once, with the text whose set the class has."""
    ids = ids.toDF("rep").distinct()
    if fits_broadcast(ids):
        ids = F.broadcast(ids)
    texts = docs.select(F.col(id_col).cast("bigint").alias("rep"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(ids, "rep", "left_semi")


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs, by their full sets."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    texts = _texts_of(ids, docs, id_col, text_col)

    def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = Hashed()
        linked, last, s = [], None, None
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if left != last:
                last, s = left, shingles(left, known)
            t = shingles(right, known)
            linked.append(similar(s, t, percent))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    right = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
    joined = right.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(per_batch(compared, 500), "a bigint, b bigint, linked boolean")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """(doc, n_shingles, component) per row: the smallest id that a document is linked to, through others too."""
    signed = stage(signatures(docs, id_col, text_col), "signatures")
    key = ["n", "f1", "f2"]
    known = signed.where("doc is not null and n > 0")
    # Rows of one id with different texts: an id stands for its class with the smallest key only.
    classes = stage(known.groupBy(*key).agg(F.min("doc").alias("rep"), F.first("steps").alias("steps"), F.first("sketch").alias("sketch")), "classes")
    least = -(-100 // (100 - percent)) if percent < 100 else 1 << 62  # smaller sets are linked only if equal
    nodes = nodes_of(classes.where(F.col("n") >= least - 1).select("rep", "steps", "sketch"))
    buckets = max(1, -(-nodes.count() // (2 * LARGE)))
    nodes = nodes.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)).cast("int"))

    proposed = stage(propose(nodes.withColumn("label", F.col("rep")), percent), "proposed")
    judged = stage(confirm(proposed.select("a", "b").distinct(), docs, id_col, text_col, percent), "judged")
    links = judged.where("linked").select("a", "b")
    failed = judged.where("not linked").select("a", "b")
    if not failed.isEmpty():
        again = proposed.join(failed, ["a", "b"], "left_semi").select("bucket").distinct()
        label = components(links).select(F.col("vertex").alias("rep"), F.col("component").alias("label"))
        doubtful = nodes.join(again, "bucket", "left_semi").join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        links = links.unionByName(stage(settle(stage(still_open(doubtful, percent), "open"), docs, id_col, text_col, percent), "settled"))
    label = components(links).select(F.col("vertex").alias("rep"), "component")
    of_class = classes.select(*key, "rep").join(label, "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    joined = signed.select("doc", *key).join(of_class, key, "left")
    component = F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.least("component", "doc")).otherwise(F.col("doc")))
    return joined.select("doc", F.col("n").alias("n_shingles"), component.alias("component"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` without the documents that are linked to one with a smaller id; rows that repeat an id and text count once."""
    found = stage(near_copies(docs, id_col, text_col, percent), "near-copies")
    gone = found.where("doc != component").select("doc").distinct().alias("g")
    if fits_broadcast(gone):
        gone = F.broadcast(gone)
    kept = docs.alias("d").join(gone, F.col(f"d.`{id_col}`") == F.col("g.doc"), "left_anti")
    if found.where("doc is not null").groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return kept
    # Only a table that repeats ids pays for bringing its rows together.
    row = fresh("row", docs.columns)
    once = kept.where(F.col(f"`{id_col}`").isNotNull()).withColumn(row, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    once = once.dropDuplicates([id_col, row]).drop(row)
    return once.unionByName(kept.where(F.col(f"`{id_col}`").isNull()))


@query("op6_near_copies")
def op6_near_copies(spark, sf_dir):
    found = near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept")
    )
