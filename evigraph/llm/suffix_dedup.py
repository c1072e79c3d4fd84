"""Suffix-array deduplication by bucket-pointer refinement (operator 3).

Bytes covered by a LENGTH-byte string that also starts elsewhere are removed. Suffixes are sorted only as far as
that needs: to depth LENGTH.

1. Buckets across texts: each string of LENGTH bytes is represented by its q-gram (GRAM bytes) of least hash, the
   leftmost of equals: equal strings have it at the same place, so only these suffixes, about one in 85, are
   exchanged, each with the range of strings that it stands for (its run) and a digest of the run's bytes. Runs with
   the same bytes are copies: all their strings are repeated, and one of them stands for the others. Copies within a
   slice of texts are put together before the exchange, so a passage that is everywhere sends a row for each slice.
2. Buckets whose runs all have the same bytes are done. Of the others one run of each kind gets its bytes.
3. Refinement: every suffix of these bytes starts in the bucket of its first GRAM0 bytes. Suffixes of a bucket that
   holds several are sorted on the pointers to the buckets of the suffixes GRAM0, later 2, 4, 8 ... times as far on,
   which tells bucket from bucket at twice the depth, and the new pointers serve the next round; a suffix alone in
   its bucket keeps it. At depth LENGTH buckets with several suffixes hold the strings that are repeated. Pointers
   are numbers of sorted buckets, so nothing is taken as equal that isn't.

Buckets with over HOT kinds of runs are not gathered in a task: digests of their strings are aggregated instead.
Equal texts are one text whose bytes, from LENGTH on, are all repeated. A null text is empty. Rows with the same
doc_id, or without one, are separate documents. Texts are told apart by 128-bit digests, the bytes of runs by 64-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from .arrow import SLICE, bounded_batches, column, quoted, releasing, with_computed
from .storage import dropped, slices, written
from .wordhash import MIX, mixed, prefix_sums, span_hashes, text_bytes

LENGTH, GRAM, GRAM0 = 200, 32, 8
#: Kinds of runs of a bucket, about 280 bytes each, that one task sorts.
HOT = 4_000
_WINDOW = LENGTH - GRAM + 1


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: positions of representing q-grams, first and last start of the strings that each stands for,
    and the q-gram's bucket."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    sums = prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = span_hashes(sums, at, at + GRAM)
    blocks = -(-len(gram) // _WINDOW) + 1
    low = np.uint64(255)
    keys = np.full((blocks, _WINDOW), ~np.uint64(0))
    keys.reshape(-1)[: len(gram)] = gram & ~low
    keys |= np.arange(_WINDOW, dtype=np.uint64)
    before = np.minimum.accumulate(keys, axis=1).reshape(-1)
    after = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    # Strings within one text.
    whole = np.zeros(len(data) + 1, np.int8)
    size = np.diff(offsets)
    texts = np.flatnonzero(size >= LENGTH)
    whole[offsets[texts]] += 1
    whole[offsets[texts] + size[texts] - LENGTH + 1] -= 1
    start = np.flatnonzero(np.cumsum(whole[:n]) > 0)
    left, right = after[start], before[start + _WINDOW - 1]
    first = (left | low) <= (right | low)
    place = np.where(first, start // _WINDOW * _WINDOW + (left & low).astype(np.int64), (start + _WINDOW - 1) // _WINDOW * _WINDOW + (right & low).astype(np.int64))
    edge = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(edge[1:], len(place)) - 1
    return place[edge], start[edge], start[last], gram[place[edge]].view(np.int64)


def pointers(data: np.ndarray) -> np.ndarray:
    """Numbers of the buckets, to depth LENGTH, of all positions that have as many bytes after them."""
    first = np.ndarray(len(data) - GRAM0 + 1, "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    at, depth = np.unique(first, return_inverse=True)[1], GRAM0
    top = int(at.max()) + 1
    while depth < LENGTH:
        step = min(depth, LENGTH - depth)
        here, there = at[: len(at) - step], at[step:]
        several = np.flatnonzero(np.bincount(here, minlength=top)[here] > 1)
        new = here.copy()
        if len(several):
            # Sorted on (own bucket, later offset's bucket); new buckets are numbered after the old ones.
            new[several] = top + np.unique(here[several] * top + there[several], return_inverse=True)[1]
            top = int(new.max()) + 1
        at, depth = new, depth + step
    return at


def _digest() -> Column:
    return F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16)


def _members(data: np.ndarray, offsets: np.ndarray):
    """Of distinct texts: bucket, digest of the bytes (kind), row, position, distances to the first and last start,
    and whether another run of these texts has the same bytes; of such runs one is given, and the bytes covered by
    all of them as row, from, to."""
    place, low, high, bucket = runs(data, offsets)
    whole = data.tobytes()
    digests = b"".join(hashlib.blake2b(whole[a:b], digest_size=8).digest() for a, b in zip(low.tolist(), (high + LENGTH).tolist()))
    left, right = place - low, place - high
    kind = mixed(np.frombuffer(digests, np.uint64) + (left << 8 | right).astype(np.uint64) * MIX).view(np.int64)
    row = np.searchsorted(offsets, place, side="right") - 1
    order = np.lexsort((kind, bucket))
    b, k = bucket[order], kind[order]
    head = np.ones(len(order), bool)
    head[1:] = (b[1:] != b[:-1]) | (k[1:] != k[:-1])
    starts = np.flatnonzero(head)
    times = np.diff(np.append(starts, len(order)))
    one = order[starts]
    copied = np.zeros(len(order), bool)
    copied[order] = np.repeat(times > 1, times)
    # Runs follow each other in their text; covered bytes that meet are one stretch.
    which = np.flatnonzero(copied)
    owner, a, z = row[which], low[which], high[which] + LENGTH
    begin = np.ones(len(which), bool)
    begin[1:] = (owner[1:] != owner[:-1]) | (a[1:] > z[:-1])
    edge = np.flatnonzero(begin)
    last = np.append(edge[1:], len(which))[: len(edge)] - 1
    base = offsets[owner[edge]]
    return (bucket[one], kind[one], row[one], (place - offsets[row])[one], left[one], right[one], times > 1), (owner[edge], a[edge] - base, z[last] - base)


#: Rows of members: a run alone in its slice, one that stands for several, or covered bytes (from, length).
ALONE, SEVERAL, COVERED = 0, 1, 2


def _anchors(texts: DataFrame) -> DataFrame:
    """bucket, kind, digest, first_id (of a row with the text), at, extent and state of the runs of each slice of texts;
    covered bytes are rows of their own."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, "text", 4 * SLICE):
                known: dict[bytes, int] = {}  # of equal texts the first row by id
                ids = column(batch, "first_id").to_pylist()
                for i, digest in enumerate(column(batch, "digest").to_pylist()):
                    if ids[known.setdefault(digest, i)] > ids[i]:
                        known[digest] = i
                if len(known) < len(batch):
                    batch = batch.take(pa.array(list(known.values())))
                data, offsets = text_bytes(column(batch, "text"))
                (bucket, kind, row, at, left, right, several), (owner, low, high) = _members(data, offsets)
                apart = mixed((owner.astype(np.uint64) + bucket.sum().astype(np.uint64)) * MIX).view(np.int64)
                rows = np.concatenate([row, owner])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([bucket, apart])),
                        pa.array(np.concatenate([kind, mixed(apart.view(np.uint64)).view(np.int64)])),
                        column(batch, "digest").take(pa.array(rows)),
                        column(batch, "first_id").take(pa.array(rows)),
                        pa.array(np.concatenate([at, low])),
                        pa.array(np.concatenate([left << 8 | right, high - low])),
                        pa.array(np.concatenate([several.astype(np.int32), np.full(len(owner), COVERED, np.int32)])),
                    ],
                    names=["bucket", "kind", "digest", "first_id", "at", "extent", "state"],
                )

    return bounded_batches(texts).select("digest", "first_id", "text").mapInArrow(releasing(find), "bucket long, kind long, digest binary, first_id long, at long, extent long, state int")


def _judged(members: DataFrame) -> DataFrame:
    """digest, first_id, at, extent, state and bucket of members whose strings are all repeated (``copied``), or that stand for
    their kind in a bucket of ``kinds`` kinds, more than one. Other members go. One exchange, one sort."""
    by_bucket, by_kind = Window.partitionBy("bucket"), Window.partitionBy("bucket", "kind")
    differ = lambda c: F.min(c).over(by_kind) != F.max(c).over(by_kind)
    placed = members.repartition("bucket").withColumn("first", F.row_number().over(by_kind.orderBy("digest", "at", "first_id")) == 1)
    placed = placed.withColumn("copied", (F.max("state").over(by_kind) > ALONE) | differ("digest") | differ("at"))
    placed = placed.withColumn("kinds", F.sum(F.when(F.col("first") & (F.col("state") != COVERED), 1).otherwise(0)).over(by_bucket))
    placed = placed.withColumn("first", F.col("first") & (F.col("state") != COVERED) & (F.col("kinds") > 1))
    return placed.filter("copied or first").drop("kind")


def _around(texts: DataFrame) -> DataFrame:
    """bucket, digest, low (first start) and the bytes of its strings, for ``texts(digest, text, buckets, lows, highs)``."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                data, offsets = text_bytes(column(batch, "text"))
                lists = column(batch, "lows")
                row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
                low, high = lists.flatten().to_numpy(), column(batch, "highs").flatten().to_numpy()
                whole_bytes = data.tobytes()
                around = [whole_bytes[a:b] for a, b in zip((low + offsets[row]).tolist(), (high + offsets[row]).tolist())]
                yield pa.RecordBatch.from_arrays([column(batch, "buckets").flatten(), column(batch, "digest").take(pa.array(row)), pa.array(low), pa.array(around, pa.binary())], names=["bucket", "digest", "low", "bytes"])

    return texts.select("digest", "text", "buckets", "lows", "highs").mapInArrow(releasing(cut), "bucket long, digest binary, low long, bytes binary")


def _strings(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of Arrow rows (low, bytes): their bytes, and row, place in the bytes and start of every string of their runs."""
    data, offsets = text_bytes(column(rows, "bytes"))
    low = column(rows, "low").to_numpy()
    count = np.diff(offsets) - LENGTH + 1
    row = np.repeat(np.arange(len(low)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return data, row, offsets[:-1][row] + within, low[row] + within


def _repeated_in_task(around: DataFrame) -> DataFrame:
    """digest, low, high: the covered bytes of each run, by sorting the strings of whole buckets in a task."""

    def sort(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def refine(held: list):
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            digests = column(rows, "digest")
            key = np.unique(np.array(digests.to_pylist(), "S16"), return_inverse=True)[1]
            data, row, place, start = _strings(rows)
            identifier = pointers(data)[place]
            order = np.argsort(identifier, kind="stable")
            sorted_ids = identifier[order]
            # A row given twice (the same document twice) repeats nothing: members of a bucket must differ.
            text, begin = key[row][order], start[order]
            head = np.flatnonzero(np.diff(sorted_ids, prepend=-1))
            group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
            other = (text != text[head][group]) | (begin != begin[head][group])
            twice = np.zeros(len(head), bool)
            twice[group[other]] = True
            hit = order[twice[group]]
            low = np.full(len(key), 1 << 62)
            high = np.full(len(key), -1)
            np.minimum.at(low, row[hit], start[hit])
            np.maximum.at(high, row[hit], start[hit] + LENGTH)
            found = np.flatnonzero(high >= 0)
            return pa.RecordBatch.from_arrays([digests.take(pa.array(found)), pa.array(low[found]), pa.array(high[found])], names=["digest", "low", "high"])

        held, rows = [], 0
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            # The batch's rows from ``cut`` on belong to a bucket that may go on in the next batch.
            change = np.flatnonzero(bucket != bucket[-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            goes_on = bool(held) and not cut and held[-1].column(0)[-1].as_py() == bucket[0]
            if rows + cut >= HOT and not goes_on:
                yield refine([*held, batch.slice(0, cut)])
                held, rows, batch = [], 0, batch.slice(cut)
            held.append(batch)
            rows += len(batch)
        if rows:
            yield refine(held)

    ordered = around.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(releasing(sort), "digest binary, low long, high long")


def _repeated_by_identifier(around: DataFrame) -> DataFrame:
    """The same for large buckets: identifiers are aggregated, so no task holds a bucket."""

    def spread(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, "bytes", SLICE):
                data, row, place, start = _strings(batch)
                rows, content = pa.array(row), data.tobytes()
                identifier = [hashlib.blake2b(content[a : a + LENGTH], digest_size=16).digest() for a in place.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(identifier, pa.binary()), column(batch, "digest").take(rows), column(batch, "low").take(rows), pa.array(start)], names=["identifier", "digest", "run", "start"])

    every = written(around.mapInArrow(releasing(spread), "identifier binary, digest binary, run long, start long"), "strings")
    bounds = every.groupBy("identifier").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("digest", "start")))
    twice = bounds.filter("min_digest != max_digest or min_start != max_start").select("identifier")
    hit = every.join(twice, "identifier", "left_semi").groupBy("digest", "run").agg(F.min("start").alias("low"), (F.max("start") + LENGTH).alias("high"))
    return hit.select("digest", "low", "high")


def with_repeats(docs: DataFrame, keep: list[str] | None = None, hot: int = HOT, fields: list[StructField] | None = None, derive=None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``repeat_spans``: from, to, from, to ... of the maximal repeated runs of
    bytes; or with ``fields``, which ``derive`` makes of a batch and the spans of its rows, in the same pass over the
    texts. Column names starting with ``own_`` are used on the way."""
    names = docs.columns if keep is None else keep
    texts = docs.select(_digest().alias("own_digest"), F.octet_length("text").alias("size")).filter(f"size >= {LENGTH}")
    copies = texts.groupBy("own_digest").agg(F.first("size").alias("own_size"), F.count("*").alias("own_copies")).filter("own_copies > 1")

    own = docs.select("doc_id", "text").filter(F.octet_length("text") >= LENGTH).select("text", _digest().alias("digest"), F.coalesce("doc_id", F.lit(-1 << 62)).alias("first_id"))
    judged = members = written(_judged(_anchors(own)), "members")
    low = F.when(F.col("state") == COVERED, F.col("at")).otherwise(F.col("at") - F.shiftright("extent", 8))
    high = F.when(F.col("state") == COVERED, F.col("at") + F.col("extent")).otherwise(F.col("at") - F.col("extent").bitwiseAND(255) + LENGTH)
    members = members.withColumns({"low": low, "high": high})

    def around(rows: DataFrame) -> DataFrame:
        # A text's runs, to be cut out of one row of it; the grouping's exchange serves the join as well.
        lists = rows.groupBy("digest", "first_id").agg(F.collect_list(F.struct("bucket", "low", "high")).alias("own"))
        places = lists.select("digest", "first_id", *(F.col(f"own.{c}").alias(f"{c}s") for c in ("bucket", "low", "high")))
        return _around(own.join(places.hint("merge"), ["digest", "first_id"]))

    open_ones = members.filter("first")
    found = _repeated_in_task(around(open_ones.filter(F.col("kinds") <= hot)))
    large = open_ones.filter(F.col("kinds") > hot)
    if not large.isEmpty():
        found = found.unionByName(_repeated_by_identifier(around(large)))
    found = found.unionByName(members.filter("copied").select("digest", "low", "high"))
    covered = written(found, "spans")
    dropped(judged)
    spans = covered.groupBy(F.col("digest").alias("own_digest")).agg(F.collect_set(F.struct("low", "high")).alias("own"))
    spans = spans.select("own_digest", F.col("own.low").alias("own_low"), F.col("own.high").alias("own_high"))
    copies = written(copies, "copies")
    read = [F.col(quoted(name)) for name in dict.fromkeys([*names, "text"])]
    joined = docs.select(*read, _digest().alias("own_digest")).join(spans.hint("merge"), "own_digest", "left").join(copies.hint("merge"), "own_digest", "left")

    def make():
        import pyarrow as pa

        def compute(batch):
            lows, highs = column(batch, "own_low").to_pylist(), column(batch, "own_high").to_pylist()
            out = []
            for low, high, size, copies in zip(lows, highs, column(batch, "own_size").to_pylist(), column(batch, "own_copies").to_pylist()):
                merged: list[int] = []
                if copies is not None:
                    merged = [0, size]
                elif low:
                    for a, b in sorted(zip(low, high)):
                        if merged and a <= merged[-1]:
                            merged[-1] = max(merged[-1], b)
                        else:
                            merged += [a, b]
                out.append(merged)
            return derive(pa, batch, out) if derive else [pa.array(out, pa.list_(pa.int64()))]

        return compute

    working = ["own_low", "own_high", "own_size", "own_copies"]
    made = fields if derive else [StructField("repeat_spans", ArrayType(LongType()))]
    return with_computed(joined.drop("own_digest"), made, make, keep=names, read=working)


def _kept(data: np.ndarray, spans: list[int]) -> bytes:
    keep = np.ones(len(data), bool)
    for a, b in zip(spans[::2], spans[1::2]):
        keep[a:b] = False
    return data[keep].tobytes()


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that remain) of every row of ``docs``."""

    def derive(pa, batch, spans):
        data, offsets = text_bytes(column(batch, "text"))
        digests = [hashlib.sha256(_kept(data[a:b], s)).hexdigest() for a, b, s in zip(offsets.tolist(), offsets[1:].tolist(), spans)]
        removed = [sum(s[1::2]) - sum(s[::2]) for s in spans]
        return [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array(digests)]

    fields = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType())]
    return with_repeats(docs.select("doc_id", "text"), keep=["doc_id"], fields=fields, derive=derive)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of its text, and n_chars (if it has that column) counted anew.

    Bytes of a character that was cut apart go too, as they are no text. A null text stays null.
    """

    def derive(pa, batch, spans):
        text = column(batch, "text")
        data, offsets = text_bytes(text)
        there = text.is_valid().to_pylist()
        rest = [_kept(data[a:b], s).decode("utf-8", "ignore") if ok else None for a, b, s, ok in zip(offsets.tolist(), offsets[1:].tolist(), spans, there)]
        return [pa.array(rest, pa.string())]

    names = docs.columns
    prefixed = docs.select(*(F.col(quoted(c)).alias(c if c in ("doc_id", "text") else f"in_{c}") for c in names))
    found = with_repeats(prefixed, keep=[c for c in prefixed.columns if c != "text"], fields=[StructField("kept_text", StringType())], derive=derive)
    columns = {c: F.col(quoted(f"in_{c}")) for c in names} | {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(columns[c].alias(c) for c in names))
