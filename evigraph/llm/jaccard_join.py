"""N-gram Jaccard join over metric regions (operator 2).

A document is the set of its 5-word shingles. Jaccard distance is a metric, and sets within 0.2 of each other are
linked. The join goes from coarse to fine pivots:

1. Pivots are single shingles. A document that holds a shingle is nearer to it (1 - 1/n) than one that doesn't (1),
   so a shingle's Voronoi region is its holders. Linked sets of n shingles at most differ so little that they share
   one of the n - ceil(0.8 n) + 1 shingles that come first in any order of all shingles: into those regions a document
   is replicated. The order is by hash, but the shingles that most documents have come last, as their regions would be
   large and tell little. Which ones these are is a matter of cost only; any order gives the same links.
2. In a region every document is first compared with two pivots, the smallest and the largest; the exact links
   found make up preliminary components, and only pairs across these are still of interest.
3. Regions of over three documents with more than one component are joined recursively: two members become pivots, the others go to the
   nearer one and, within the window that the triangle inequality sets, to both. The distance there is the L1 distance
   of histograms of shingle hashes over the same bins, which is a metric that never exceeds the size of the symmetric
   difference. Counts that are clipped are clipped again when bins are summed: min(min(a, 3) + min(b, 3), 3) is
   min(a + b, 3), so sets of different sizes are compared at one level.
4. Pairs that remain are compared exactly.

Regions of more than REGION documents are split by pivots as in step 3, in rounds of Spark, until they have at most REGION
members; what pivots don't split is cut into blocks by size, and each two blocks whose sizes allow links are a region. So
no task holds more than about REGION members of a region. Shingles are 64-bit hashes of their words. Equal sets are one
node.

Words are lower-cased (A-Z) stretches between ASCII white space. A document with one to four words is one
shingle; without words (or null) it has none and is linked with nothing. Rows that repeat a doc_id belong
together; a row without doc_id is linked with nothing and has a null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from .arrow import SLICE, bounded_batches, column, quoted, releasing, with_computed
from .components import components
from .storage import deleted, dropped, slices, watched, written
from .token_counts import word_spans
from .wordhash import MIX, mixed, text_bytes, word_hashes

WORDS = 5
#: Documents of a region that one task joins; bounds its work to a product of sorted windows. A document of more than
#: UNIT shingles counts as so many times more, as its histogram takes so much more memory.
REGION = 20_000
#: Candidate pairs of a region that are given at a time.
PAIRS = 1 << 19
UNIT = 500
#: Documents that have a common shingle, and how many such shingles are told to all tasks, those with most documents first.
COMMON, COMMON_SHINGLES = 1_000, 200_000
#: Histograms are folded to so many bins for the distances to pivots.
BINS = 64
#: Rows of ids that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_sets(text) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of an Arrow column."""
    data, offsets = text_bytes(text)
    data = _LOWER[data]
    start, end = word_spans(data, offsets)
    word = word_hashes(data, start, end)
    first = np.searchsorted(start, offsets).tolist()
    rolled = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        rolled = rolled * MIX + word[k : k + len(rolled)]
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(first, first[1:]):
        if b - a >= WORDS:
            sets.append(np.unique(rolled[a : b - WORDS + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for h in word[a:b]:
                short = short * MIX + h
            sets.append(mixed(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def window_size(n: int) -> int:
    """How many shingles a linked set of at most this size may lack, and one more."""
    return n - -(-4 * n // 5) + 1 if n else 0


def histogram(shingles: np.ndarray) -> bytes:
    """Counts of shingles by the high bits of their hash in BINS * 2**k bins, two to four for each shingle, two bits each
    (at most 3); before them, for each of BINS bins, a byte of what these leave out (mostly 0, at most 255)."""
    bits = max(BINS.bit_length() + 1, (2 * len(shingles)).bit_length())
    whole = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    excess = np.minimum((whole - np.minimum(whole, 3)).reshape(BINS, -1).sum(axis=1), 255).astype(np.uint8)
    counts = np.minimum(whole, 3).astype(np.uint8).reshape(-1, 4)
    return excess.tobytes() + (counts[:, 0] | counts[:, 1] << 2 | counts[:, 2] << 4 | counts[:, 3] << 6).tobytes()


def counts_of(packed: np.ndarray) -> np.ndarray:
    """The fine counts of rows of packed histograms."""
    packed = packed[..., BINS:]
    return np.stack([packed >> k & 3 for k in (0, 2, 4, 6)], axis=-1).reshape(*packed.shape[:-1], -1)


def coarse_of(packed: np.ndarray) -> np.ndarray:
    """The counts of rows of packed histograms in BINS bins, at most 255."""
    counts = counts_of(packed)
    fine = counts.reshape(len(counts), BINS, -1).sum(axis=2, dtype=np.int64)
    return np.minimum(fine + packed[:, :BINS], 255).astype(np.int16)


def common_shingles(docs: DataFrame, least: int = COMMON, most: int = COMMON_SHINGLES) -> np.ndarray:
    """Shingles that come first by hash in at least ``least`` documents, the ``most`` commonest, sorted.

    Tasks count over all their documents and leave out what they have met once, which makes counts a little too low.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[np.ndarray] = []
        size = 0

        def flush():
            shingles, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(shingles[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["shingle", "n"])

        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                sets = shingle_sets(column(batch, "text"))
                held += [s[: window_size(len(s))] for s in sets]
                size += sum(window_size(len(s)) for s in sets)
                if size > 1 << 21:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counts = bounded_batches(docs).select("text").mapInArrow(releasing(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most).select("shingle").collect()
    return np.sort(np.array([r.shingle for r in found], np.int64).view(np.uint64))


def first_shingles(sets: list[np.ndarray], common: np.ndarray) -> list[np.ndarray]:
    """Of each sorted set the first ``window_size`` shingles, common ones after all others."""
    if not len(common):
        return [s[: window_size(len(s))] for s in sets]
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    late = common[np.minimum(np.searchsorted(common, every), len(common) - 1)] == every
    out, at = [], 0
    for s in sets:
        n, mark = window_size(len(s)), late[at : at + len(s)]
        at += len(s)
        out.append(np.concatenate([s[~mark], s[mark]])[:n] if mark[:n].any() else s[:n])
    return out


def sets_table(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, digest of the set, first shingles and histogram, for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # at most COMMON_SHINGLES numbers

    def make():
        import pyarrow as pa

        def compute(batch):
            sets = shingle_sets(column(batch, "text"))
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in first_shingles(sets, shared.value)], pa.list_(pa.int64())),
                pa.array([histogram(s) if len(s) else b"" for s in sets], pa.binary()),
            ]

        return compute

    fields = [StructField("n_shingles", LongType()), StructField("digest", BinaryType()), StructField("first", ArrayType(LongType())), StructField("bins", BinaryType())]
    return with_computed(docs.select("doc_id", "text"), fields, make, keep=["doc_id"])


def _sized(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if it has few rows."""
    return F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids


def exact_links(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of node ids whose sets are linked, by the shingles of their texts; written. ``pairs`` is a table of ``written``, which
    goes."""
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "nodes")
    texts = docs.select("doc_id", "text").join(_sized(nodes), "doc_id", "left_semi")

    def make():
        import pyarrow as pa

        return lambda batch: [pa.array([s.tobytes() for s in shingle_sets(column(batch, "text"))], pa.binary())]

    sets = written(with_computed(texts, [StructField("shingles", BinaryType())], make, keep=["doc_id"]), "shingles")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))

    def check(batches: Iterator) -> Iterator:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= 80 * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).take(np.flatnonzero(keep))

    links = written(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(releasing(check), "a long, b long"), "links")
    for table in (nodes, sets, pairs):
        dropped(table)
    return links


def _folded(bins: np.ndarray, to: int) -> np.ndarray:
    """Rows of fine counts summed up to fewer bins, and clipped as if they had been counted there."""
    return np.minimum(bins.reshape(len(bins), to, -1).sum(axis=2, dtype=np.int16), 3)


def _distance(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.abs(rows - one).sum(axis=1, dtype=np.int64)


class Region:
    """Members of one region: node, size, component and histograms, fine and coarse."""

    def __init__(self, node, size, component, bins: list[bytes]):
        self.node, self.size, self.component = node, size, component
        self.bins = np.array([len(b) - BINS for b in bins])
        self.place = np.zeros(len(bins), np.int64)
        self.folded = np.zeros((len(bins), BINS), np.int16)
        # Members of one number of bins as a matrix, also with half as many for those that are smaller.
        self.whole, self.half = {}, {}
        for n in np.unique(self.bins).tolist():
            which = np.flatnonzero(self.bins == n)
            rows = np.frombuffer(b"".join(bins[i] for i in which), np.uint8).reshape(len(which), BINS + n)
            self.place[which] = np.arange(len(which))
            self.folded[which] = coarse_of(rows)
            rows = counts_of(rows)
            self.whole[n] = rows.astype(np.int16)
            self.half[n] = _folded(rows, rows.shape[1] // 2)

    def join(self) -> set[tuple[int, int]]:
        """Pairs across components that the histograms don't rule out."""
        return {tuple(pair) for rows in self.pairs() for pair in rows.tolist()}

    def pairs(self) -> Iterator[np.ndarray]:
        """The same as arrays of at most about PAIRS rows; a pair may come twice."""
        held, size = [], 0
        for rows in self._join(np.argsort(self.size, kind="stable")):
            held.append(rows)
            size += len(rows)
            if size >= PAIRS:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)

    def _join(self, who: np.ndarray) -> Iterator[np.ndarray]:
        if len(who) > 256:
            reach = 2 * int(self.size[who].max()) // 9  # no linked pair differs by more
            far = _distance(self.folded[who], self.folded[who[0]])
            other = who[int(far.argmax())]
            gap = _distance(self.folded[who], self.folded[other]) - far
            near, beyond = who[gap >= -2 * reach], who[gap <= 2 * reach]
            if max(len(near), len(beyond)) < 0.9 * len(who):
                yield from self._join(near)
                yield from self._join(beyond)
                return
        yield from self._compare(who)

    def _compare(self, who: np.ndarray) -> Iterator[np.ndarray]:
        """Members in order of size: each with those up to a quarter larger."""
        stop = np.searchsorted(self.size[who], self.size[who] * 5 // 4, side="right")
        for i in range(len(who) - 1):
            one, others = who[i], who[i + 1 : stop[i]]
            others = others[self.component[others] != self.component[one]]
            if len(others) > 8:  # coarse bins first
                others = others[9 * _distance(self.folded[others], self.folded[one]) <= self.size[others] + self.size[one]]
            n = int(self.bins[one])
            for rows, bins in ((self.whole, n), (self.half, 2 * n)):
                same = others[self.bins[others] == bins]
                if len(same):
                    close = 9 * _distance(rows[bins][self.place[same]], self.whole[n][self.place[one]]) <= self.size[same] + self.size[one]
                    b = self.node[same[close]]
                    a = np.full(len(b), self.node[one])
                    yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def region_pairs(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) within the regions of ``members(region, node, size, component, bins)``."""

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list = []

        def pairs(table):
            region = table.column("region").to_numpy()
            node, size, component = (table.column(c).to_numpy() for c in ("node", "size", "component"))
            bins = table.column("bins").to_pylist()
            edges = np.flatnonzero(np.diff(region, prepend=~region[:1], append=~region[-1:]))
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if b - a > 1:
                    for rows in Region(node[a:b], size[a:b], component[a:b], bins[a:b]).pairs():
                        rows = np.unique(rows, axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            region = batch.column(0).to_numpy()
            last = region[-1]
            cut = int(np.flatnonzero(region != last)[-1]) + 1 if region[0] != last else 0
            if cut:  # a region may go on in the next batch
                held[-1] = batch.slice(0, cut)
                yield from pairs(pa.Table.from_batches(held))
                held = [batch.slice(cut)]
        if held:
            yield from pairs(pa.Table.from_batches(held))

    rows = members.select("region", "node", "size", "component", "bins").repartition("region").sortWithinPartitions("region")
    return rows.mapInArrow(releasing(join), "a long, b long").distinct()


def _load(size: str = "size"):
    """What the members of a region count for together."""
    return F.sum(F.greatest(F.lit(1), F.ceil(F.col(size) / UNIT))).alias("count")


def _shared(rows: DataFrame) -> DataFrame:
    """Of ``rows(region, node, size)`` those of regions with two members at least, with what these count for and the smallest
    node."""
    rows = rows.filter(F.col("region").isNotNull()).repartition("region")  # one exchange for both sides
    regions = rows.groupBy("region").agg(_load(), F.min("node").alias("pivot"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return rows.join(regions, "region")


def _with_neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` of regions without members that no other member can be linked with by size: of a linked pair all members
    between them by size are near enough to both, so one next to each is."""
    order = Window.partitionBy("region").orderBy("size", "node")
    near = lambda other: F.coalesce(5 * F.least(other, "size") >= 4 * F.greatest(other, "size"), F.lit(False))
    return rows.withColumns({"_before": F.lag("size").over(order), "_after": F.lead("size").over(order)}).filter(near(F.col("_before")) | near(F.col("_after"))).drop("_before", "_after")


def _with_distance(rows: DataFrame, pivot: str, name: str) -> DataFrame:
    """``rows`` without the column ``pivot``, and with the coarse distance of ``bins`` to it."""

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            far = []
            for x, y in zip(batch.column("bins"), batch.column(pivot)):
                x, y = (coarse_of(np.frombuffer(v.as_buffer(), np.uint8)[None]) for v in (x, y))
                far.append(int(_distance(x, y)[0]))
            rest = [k for k, c in enumerate(batch.schema.names) if c != pivot]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), pa.array(far, pa.int64())], names=[*(batch.schema.names[k] for k in rest), name])

    return rows.mapInArrow(releasing(measure), rows.drop(pivot).schema.add(name, "long"))


def _blocks(large: DataFrame, region_rows: int) -> DataFrame:
    """Regions of two blocks each, in place of regions that pivots don't split. Blocks follow the order of sizes."""
    half = max(1, region_rows // 2)
    order = Window.partitionBy("region").orderBy("size")
    sizes = large.groupBy("region", "size").agg(_load().alias("c")).withColumn("before", F.sum("c").over(order) - F.col("c"))
    # Members of one size are dealt by a hash over the ranks that they take together; large ones take several.
    rank = F.col("before") + F.pmod(F.xxhash64("node", "bins"), F.col("c"))
    placed = written(large.join(_sized(sizes), ["region", "size"]).withColumn("block", F.floor(rank / half)).drop("c", "before"), "blocks")
    blocks = written(placed.groupBy("region", "block").agg(F.min("size").alias("low"), F.max("size").alias("high")), "block-sizes")
    other = blocks.select("region", F.col("block").alias("other"), F.col("low").alias("other_low"))
    cells = blocks.join(other, "region").filter("block <= other and 4 * other_low <= 5 * high")
    cells = cells.select("region", F.xxhash64("region", "block", "other").alias("cell"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    return placed.join(_sized(cells), ["region", "block"]).select(F.col("cell").alias("region"), "node", "size", "component", "bins")


def _mixed(rows: DataFrame) -> DataFrame:
    """Regions of ``rows`` with more than one component, and their count of rows."""
    found = rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"), _load())
    return found.filter("low != high").select("region", "count")


def bounded(large: DataFrame, region_rows: int) -> DataFrame:
    """Regions of at most about ``region_rows`` members that together hold each linked pair across components of
    ``large(region, node, size, component, bins)``."""
    columns = ["region", "node", "size", "component", "bins"]
    parts, turn = [], 0
    large = written(large.select(*columns), "large")
    while not large.isEmpty():
        first = large.groupBy("region").agg(F.min_by("bins", F.struct("size", "node")).alias("first"), F.max("size").alias("top"), F.count("*").alias("n"))
        rows = written(_with_distance(large.join(_sized(first), "region"), "first", "far"), "far")
        other = rows.groupBy("region").agg(F.max_by("bins", F.struct("far", "node")).alias("other"))
        rows = _with_distance(rows.join(_sized(other), "region"), "other", "gap").withColumn("gap", F.col("gap") - F.col("far"))
        reach = 2 * F.floor(2 * F.col("top") / 9)  # as in Region
        rows = written(rows.withColumn("near", F.col("gap") >= -reach).withColumn("beyond", F.col("gap") <= reach), "gaps")
        count = rows.groupBy("region").agg(F.count_if("near").alias("a"), F.count_if("beyond").alias("b"), F.count("*").alias("n"))
        # Sides that hold nearly everything, or overlap much, would only multiply the rows.
        split = written(count.select("region", F.expr("greatest(a, b) < 0.9 * n and a + b <= 1.25 * n").alias("split")), "splits")
        rows = rows.join(_sized(split), "region")
        stuck = written(rows.filter("not split").select(*columns), "stuck")
        if not stuck.isEmpty():
            parts.append(written(_blocks(stuck, region_rows), "cells"))
        sides = F.explode(F.array_compact(F.array(F.when(F.col("near"), 0), F.when(F.col("beyond"), 1))))
        halves = rows.filter("split").withColumn("side", sides).withColumn("region", F.xxhash64("region", "side", F.lit(turn)))
        halves = written(halves.select(*columns), "halves")
        halves = written(halves.join(_sized(_mixed(halves)), "region"), "halves")
        parts.append(halves.filter(F.col("count") <= region_rows).select(*columns))
        large = halves.filter(F.col("count") > region_rows).select(*columns)
        turn += 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def linked(docs: DataFrame, region_rows: int = REGION, common: int = COMMON) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs``."""
    sets = written(sets_table(docs, common_shingles(docs, common)), "shingle-sets")
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("node"))
    member = written(full.select("doc_id", "digest").join(classes, "digest").select("doc_id", "node"), "members")
    copies = member.filter("doc_id = node").select(F.col("doc_id").alias("node")).distinct()

    # Copies go before their shingles are dealt to regions.
    own = full.join(_sized(copies), F.col("doc_id") == F.col("node"), "left_semi")
    first = own.select(F.explode("first").alias("region"), F.col("doc_id").alias("node"), F.col("n_shingles").alias("size"))
    repeated = not full.groupBy("doc_id").count().filter("count > 1").isEmpty()
    if repeated:
        # A region's documents count once, also if their rows are repeated.
        first = first.groupBy("region", "node").agg(F.max("size").alias("size"))
    rows = written(_shared(first), "regions")
    infos = own.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("size"), "bins").dropDuplicates(["node", "size", "bins"])

    # Each region's two pivots, its smallest and largest document, with the others.
    last = rows.join(rows.groupBy("region").agg(F.max("node").alias("last")), "region").filter("node != last and pivot != last")
    stars = rows.filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    stars = stars.unionByName(last.select(F.col("node").alias("a"), F.col("last").alias("b"))).distinct()
    links = exact_links(_possible(stars, infos), docs)
    preliminary = components(links)

    placed = rows.join(preliminary, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Of regions with the same documents, which are many, one is joined.
    members_hash = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
    mixed_regions = placed.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("count").alias("count"), F.count("*").alias("members"), *members_hash)
    # Of up to three members each pair has a pivot, so all pairs are compared.
    mixed_regions = mixed_regions.filter("low != high and members > 3")
    mixed_regions = mixed_regions.groupBy("low", "high", "count", "h1", "h2").agg(F.min("region").alias("region"))
    mixed_regions = written(mixed_regions.select("region", "count"), "mixed-regions")

    def members_of(regions):
        rows = placed.select("region", "node", "component", "size").join(regions, "region", "left_semi")
        # A repeated doc_id may have sets of several sizes.
        rows = rows if repeated else _with_neighbours(rows)
        return rows.drop("size").join(infos, "node")

    members, too_large = members_of(mixed_regions.filter(F.col("count") <= region_rows)), mixed_regions.filter(F.col("count") > region_rows)
    if not too_large.isEmpty():
        members = members.unionByName(bounded(members_of(too_large), region_rows).select(*members.columns))
    more = exact_links(written(region_pairs(members), "pairs"), docs)
    for table in (rows, mixed_regions):
        dropped(table)
    final = components(links.unionByName(more).unionByName(member.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))))
    joined = sets.select("doc_id", "n_shingles").join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the document with the smallest doc_id.

    Rows without doc_id stay; of rows that share a doc_id the one with the first text stays.
    """
    with watched() as made:
        found = linked(docs.select("doc_id", "text")).filter("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
        found = written(found, "representatives")
    deleted(docs.sparkSession, made[:-1])
    names = list(map(quoted, docs.columns))
    rest = docs.filter("doc_id is null")
    kept = docs.join(_sized(found.select("doc_id")), "doc_id", "left_semi")
    again = found.filter("rows > 1")
    if not again.isEmpty():
        order = Window.partitionBy("doc_id").orderBy("text", *(F.col(quoted(c)) for c in docs.columns if c not in ("doc_id", "text")))
        twice = kept.join(again, "doc_id", "left_semi").withColumn("own_place", F.row_number().over(order)).filter("own_place = 1")
        kept = kept.join(again, "doc_id", "left_anti").unionByName(twice.select(*names))
    return kept.select(*names).unionByName(rest)


def _possible(pairs: DataFrame, infos: DataFrame) -> DataFrame:
    """Pairs that sizes and histograms don't rule out."""
    side = lambda name, size: infos.select(F.col("node").alias(name), F.col("size").alias(size))
    sized = pairs.join(side("a", "n"), "a").join(side("b", "m"), "b").filter("5 * least(n, m) >= 4 * greatest(n, m)")
    sized = sized.join(infos.select(F.col("node").alias("a"), F.col("size").alias("n"), F.col("bins").alias("x")), ["a", "n"])
    sized = sized.join(infos.select(F.col("node").alias("b"), F.col("size").alias("m"), F.col("bins").alias("y")), ["b", "m"])

    def check(batches: Iterator) -> Iterator:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = []
            for k, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint8)[None] for v in (x, y))
                apart = _distance(coarse_of(x), coarse_of(y))[0]
                if 9 * apart <= n[k] + m[k]:
                    x, y = counts_of(x), counts_of(y)
                    bins = min(x.shape[1], y.shape[1])
                    apart = _distance(_folded(x, bins), _folded(y, bins))[0]
                keep.append(9 * apart <= n[k] + m[k])
            yield batch.select([0, 1]).take(np.flatnonzero(keep))

    found = sized.select("a", "b", "n", "m", "x", "y").mapInArrow(releasing(check), "a long, b long")
    return written(found.distinct(), "pairs")
