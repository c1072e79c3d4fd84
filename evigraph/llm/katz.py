"""Katz backoff language model, and the log10 probability of whole texts under it (operator 13).

Tokens are words between ASCII white space, with A-Z lower-cased, then one end; a null text has only the end. The model has order
2: with c the counts of all training rows,

    P(w | h) = d2(c(h w)) c(h w) / c(h)        if h w was seen
               alpha(h) P(w)                    else; alpha is 1 for a context that was not seen
    P(w)     = d1(c(w)) c(w) / N                if w was seen, else the mass that discounting leaves

d1 and d2 are Good-Turing discounts: Turing's estimate up to TURING where it lies between 0 and 1, above it the log-linear fit of the
counts of counts (Gale and Sampson). The fit is below 1 for every count, so each context leaves some mass, and alpha(h) = (mass that h
leaves) / (1 - sum of P(w) over what was seen after h) normalises exactly. The context of the first token is a start that is counted
once a row. Unseen words share one mass. Without any training row every token has probability 1.

Rows are taken in chunks of about CHUNK bytes of text (or one text), written once. A chunk asks for the totals of its distinct words,
then of its distinct pairs; requests are dealt out over buckets of about ENTRIES keys, summed there over all chunks, and answered to
each chunk in its own order. So a frequent word or pair costs a bucket one entry a chunk, and contexts seen more than
SPLIT times are dealt out by the word that follows, in parts by their count. Words are told apart by their bytes (over 15 bytes: by a
120-bit digest).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .arrow import BATCH_ROWS, bounded_batches, column, quoted, released
from .storage import arrow_rows, dropped, slices, written
from .wordhash import mixed, text_bytes

CHUNK, ENTRIES, SPLIT = 8 << 20, 1 << 19, 1 << 20
TURING = 5
#: Token numbers that aren't words of a chunk.
START, END = -2, -1
SCORES = [StructField(n, LongType()) for n in ("n_tokens", "n_known", "train_tokens")] + [StructField(n, DoubleType()) for n in ("base_score", "score")]
_CHUNK = "chunk long, n_words long, sizes binary, train binary, tokens binary, words binary, counts binary"


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 modulo 7. A null id is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, byte plane by byte plane, compressed."""
    import zstandard

    whole = np.stack([np.ascontiguousarray(a).view(np.uint64) for a in arrays])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(whole.view(np.uint8).reshape(len(arrays), -1, 8).transpose(0, 2, 1)).tobytes())


def unpack(blob: bytes, k: int) -> list[np.ndarray]:
    """The ``k`` arrays of a blob, as signed numbers."""
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(k, 8, -1)
    return list(np.ascontiguousarray(planes.transpose(0, 2, 1)).reshape(k, -1).view(np.int64))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each span: its bytes and size up to 15 bytes, else a digest."""
    size = end - start
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    every = np.ndarray(len(data) + 9, "<u8", buffer=padded, strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    low = every[start] & masks[np.minimum(size, 8)]
    high = every[np.minimum(start + 8, len(data))] & masks[np.clip(size - 8, 0, 7)]
    high |= np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(size > 15)
    if len(long):
        whole = data.tobytes()
        digests = np.frombuffer(b"".join(hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(start[long].tolist(), end[long].tolist())), np.uint64).reshape(-1, 2)
        low[long] = digests[:, 0]
        high[long] = digests[:, 1] | np.uint64(0xFF << 56)
    return low, high


def numbered(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one key of each kind, and the kind of every key."""
    mark = mixed(mixed(low.copy()) ^ high)
    order = np.argsort(mark, kind="stable")
    if np.any((np.diff(mark[order]) == 0) & ((np.diff(low[order]) != 0) | (np.diff(high[order]) != 0))):
        order = np.lexsort((low, high))
    new = np.concatenate([[True], (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)])[: len(order)]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _chunk(number: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list:
    """The row of a chunk: words of each text, and for each distinct word how often training texts have it."""
    data = _LOWER[np.concatenate([p[0] for p in parts])]
    sizes = np.concatenate([np.diff(p[1]) for p in parts])
    train = np.concatenate([p[2] for p in parts])
    ends = np.cumsum(sizes)
    inside = ~_BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[ends - sizes] = True
    before = np.concatenate([[False], inside[:-1]])[: len(data)]
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate([inside[1:], [False]])[: len(data)]
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    text = np.searchsorted(ends, start, "right")
    count = np.bincount(text, minlength=len(sizes))
    low, high = word_keys(data, start, end)
    places, kind = numbered(low, high)
    # Frequent words first, so that numbers are small.
    often = np.bincount(kind, minlength=len(places))
    order = np.argsort(-often, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens, places = rank[kind], places[order]
    learnt = np.bincount(tokens[train[text]], minlength=len(places))
    return [number, len(places), pack(count), pack(train.astype(np.int64)), pack(tokens), pack(low[places], high[places]), pack(learnt)]


def chunked(docs: DataFrame, keep: list[str], text: str, train: Column, chunk_bytes: int) -> DataFrame:
    """One row a chunk: its rows' columns ``keep`` and their words."""
    rows = StructType([docs.schema[c] for c in keep])
    schema = StructType([StructField("docs", ArrayType(rows)), *StructType.fromDDL(_CHUNK)])
    source = bounded_batches(docs).select(*(F.col(quoted(c)).alias(f"own_{k}") for k, c in enumerate(keep)), F.col(quoted(text)).alias("text"), train.alias("train"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held, parts, size = [], [], 0

        def flushed():
            nonlocal held, parts, size, made
            kept = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            n = kept.num_rows
            found = pa.StructArray.from_arrays(kept.columns, fields=[f.with_name(c) for f, c in zip(kept.schema, keep)])
            values = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), found), *([x] for x in _chunk(task << 32 | made, parts))]
            held, parts, size, made = [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], names=schema.names)

        for whole in batches:
            for batch in slices(whole, "text", chunk_bytes):
                data, offsets = text_bytes(column(batch, "text"))
                held.append(batch.select(range(len(keep))))
                parts.append((data, offsets, np.asarray(column(batch, "train").to_pylist(), bool)))
                size += len(data)
                if size >= chunk_bytes or sum(map(len, held)) >= 64 * BATCH_ROWS:
                    yield flushed()
        if held:
            yield flushed()
        released(pa)

    return source.mapInArrow(run, schema)


class Discount:
    """Good-Turing discounts by counts ``r`` that ``n`` kinds have; both come from all training rows."""

    def __init__(self, r: list[int], n: list[int]):
        r, n = np.asarray(r, np.float64), np.asarray(n, np.float64)
        order = np.argsort(r)
        r, n = r[order], n[order]
        self.slope = -2.0
        if len(r) > 1:
            low, high = np.concatenate([[0], r[:-1]]), np.concatenate([r[1:], [2 * r[-1] - r[-2]]])
            fit = np.polyfit(np.log(r), np.log(2 * n / (high - low)), 1)[0]
            self.slope = min(fit, -1.05)
        known = dict(zip(r.tolist(), n.tolist()))
        self.small = np.full(TURING + 1, np.nan)
        for k in range(1, TURING + 1):
            d = (k + 1) * known.get(k + 1, 0) / (k * known[k]) if k in known else 0
            if 0 < d < 1:
                self.small[k] = d

    def freed(self, c: np.ndarray) -> np.ndarray:
        """1 - d(c) of counts of 1 or more, without cancellation."""
        found = -np.expm1((self.slope + 1) * np.log1p(1 / c))
        small = self.small[np.minimum(c, TURING).astype(np.int64)]
        return np.where((c <= TURING) & ~np.isnan(small), 1 - small, found)


class Words:
    """P(w) by the count of w."""

    def __init__(self, r: list[int], n: list[int]):
        self.discount = Discount(r, n)
        r, n = np.asarray(r, np.float64), np.asarray(n, np.float64)
        self.total = int(sum(int(a) * int(b) for a, b in zip(r, n)))
        self.kinds = int(n.sum())
        self.unseen = float((n * r * self.discount.freed(r)).sum() / self.total) if self.total else 1.0

    def __call__(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c, np.float64)
        some = np.maximum(c, 1)
        return np.where(c > 0, (1 - self.discount.freed(some)) * some / max(self.total, 1), self.unseen)


def _split_by(sender: int, to: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """For each number in ``to`` that has entries: it, the sender, and the entries, whose order stays."""
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.diff(to[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(to[order[a]]), sender, pack(*(x[order[a:b]] for x in arrays))


def _word_bucket(low: np.ndarray, high: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(mixed(high.view(np.uint64)) ^ low.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _pair_bucket(h: np.ndarray, w: np.ndarray, seen: np.ndarray, buckets: int, split: int) -> np.ndarray:
    """Buckets by context; a context seen ``split`` times or more has as many as its count asks for, by word."""
    parts = (seen // split + 1).astype(np.uint64)
    return ((mixed(h.view(np.uint64) + np.uint64(1)) % np.uint64(1 << 40) + mixed(w.view(np.uint64) + np.uint64(3)) % parts) % np.uint64(buckets)).astype(np.int64)


def _rows(batches: Iterator) -> Iterator[dict]:
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
        del batch
        released(pa)


def _batch(rows: list[tuple], schema: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    target = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))])
    columns = list(zip(*rows)) if rows else [[] for _ in target]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)


def _grouped(requests: DataFrame, buckets: int, answer, schema: str) -> DataFrame:
    """``answer`` on all rows of a bucket; it yields rows of ``schema``."""

    def run(table):
        import pyarrow as pa

        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("chunk", "data", "bucket"))))
        found = pa.Table.from_batches([_batch(list(answer(rows)), schema)])
        released(pa)
        return found

    return requests.groupBy("bucket").applyInArrow(run, schema)


REQUEST = "bucket long, chunk long, data binary"
ANSWER = "kind int, bucket long, chunk long, data binary, h long, r long, m long, b double"


def _word_requests(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        for row in _rows(batches):
            low, high = unpack(row["words"].as_py(), 2)
            (counts,) = unpack(row["counts"].as_py(), 1)
            if len(low):
                yield _batch(list(_split_by(row["chunk"].as_py(), _word_bucket(low, high, buckets), low, high, counts)), REQUEST)

    return chunks.select("chunk", "words", "counts").mapInArrow(run, REQUEST)


def _word_answers(buckets: int):
    """For each chunk the total and the number of each word that it asked for; counts of counts."""

    def answer(rows):
        low, high, counts = (np.concatenate(x) for x in zip(*(unpack(data, 3) for _, data, _ in rows)))
        chunk = np.repeat([c for c, _, _ in rows], [len(unpack(d, 3)[0]) for _, d, _ in rows])
        bucket = rows[0][2]
        places, kind = numbered(low.view(np.uint64), high.view(np.uint64))
        # In order of the words, so that a retried task gives the same numbers.
        order = np.lexsort((low[places], high[places]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        kind = rank[kind]
        total = np.zeros(len(places), np.int64)
        np.add.at(total, kind, counts)
        for to, _, data in _split_by(bucket, chunk, total[kind], kind * buckets + bucket):
            yield 0, bucket, to, data, None, None, None, None
        r, n = np.unique(total[total > 0], return_counts=True)
        for a, b in zip(r.tolist(), n.tolist()):
            yield 1, bucket, None, None, None, a, b, None

    return answer


class Chunk:
    """The words and pairs of a chunk, with the totals of its words."""

    def __init__(self, row: dict, answers: list[dict], buckets: int, words: Words, rows: int):
        value = lambda name, k=1: unpack(row[name].as_py(), k)
        (self.sizes,), (train,), (tokens,), (low, high) = value("sizes"), value("train"), value("tokens"), value("words", 2)
        seen, ids = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        if len(low):
            bucket = _word_bucket(low, high, buckets)
            order = np.argsort(bucket, kind="stable")
            got = [unpack(a["data"], 2) for a in sorted(answers, key=lambda a: a["bucket"])]
            seen[order], ids[order] = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        # Each text: a start as the first context, its words, an end. Numbers: END, START, then words.
        n = len(self.sizes)
        ends = np.cumsum(self.sizes + 1)
        token = np.empty(ends[-1] if n else 0, np.int64)
        is_end = np.zeros(len(token), bool)
        is_end[ends - 1] = True
        token[~is_end], token[is_end] = tokens, END
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[ends - self.sizes - 1] = START
        self.first = ends - self.sizes - 1
        learnt = np.repeat(train, self.sizes + 1)
        key, self.entry = np.unique((context + 2) << 32 | (token + 2), return_inverse=True)
        self.count = np.bincount(self.entry[learnt == 1], minlength=len(key)).astype(np.int64)
        h, w = (key >> 32) - 2, (key & 0xFFFFFFFF) - 2
        seen = np.concatenate([[rows, rows], seen])
        # Words that no training row has are one word, -1; END and START have numbers below it.
        ids = np.where(seen > 0, np.concatenate([[START - 1, START], ids]), -1)
        self.seen_h, self.seen_w = seen[h - START], seen[w - START]
        self.h, self.w = ids[h - START], ids[w - START]
        self.asked = np.flatnonzero(self.seen_h > 0)
        self.known = self.seen_w[self.entry]
        self.words = words

    def ordered(self, buckets: int, split: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that are asked for, by bucket, context and word, and their buckets."""
        a = self.asked
        bucket = _pair_bucket(self.h[a], self.w[a], self.seen_h[a], buckets, split)
        order = np.lexsort((self.w[a], self.h[a], bucket))
        return a[order], bucket[order]

    def requests(self, number: int, buckets: int, split: int) -> Iterator[tuple[int, int, bytes]]:
        a, bucket = self.ordered(buckets, split)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for i, j in zip(edges[:-1], edges[1:]):
            x = a[i:j]
            yield int(bucket[i]), number, _pair_request(self.h[x], self.w[x], self.count[x], self.seen_h[x], self.seen_w[x])

    def scores(self, answers: list[dict], buckets: int, split: int, discount: Discount) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each row."""
        logs = np.log10(self.words(self.seen_w))
        at, _ = self.ordered(buckets, split)
        if len(at):
            got = [unpack(x["data"], 2) for x in sorted(answers, key=lambda x: x["bucket"])]
            total = np.concatenate([g[0] for g in got])
            alpha = np.concatenate([g[1] for g in got]).view(np.float64)
            some = np.maximum(total, 1).astype(np.float64)
            logs[at] = np.where(total > 0, np.log10((1 - discount.freed(some)) * some / self.seen_h[at]), np.log10(np.where(total > 0, 1.0, alpha)) + logs[at])
        tokens = self.sizes + 1
        if not len(tokens):
            return [tokens, tokens, logs[:0], logs[:0]]
        words = self.words
        base = np.log10((self.known + 1.0) / (words.total + words.kinds + 1.0))
        return [tokens, np.add.reduceat((self.known > 0).astype(np.int64), self.first), np.add.reduceat(base, self.first), np.add.reduceat(logs[self.entry], self.first)]


def _pair_request(h: np.ndarray, w: np.ndarray, n: np.ndarray, seen_h: np.ndarray, seen_w: np.ndarray) -> bytes:
    """Pairs in order of h and w; counts of contexts and words once for each of them."""
    parts = [pack(np.diff(h, prepend=0), w, n), pack(seen_h[np.unique(h, return_index=True)[1]]), pack(seen_w[np.unique(w, return_index=True)[1]])]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def _pair_entries(data: bytes) -> tuple[np.ndarray, ...]:
    """h, w, n, seen_w and seen_h of a request."""
    a, b, _ = np.frombuffer(data[:24], np.int64)
    h, w, n = unpack(data[24 : 24 + a], 3)
    h = np.cumsum(h)
    (seen_h,), (seen_w,) = unpack(data[24 + a : 24 + a + b], 1), unpack(data[24 + a + b :], 1)
    return h, w, n, seen_w[np.unique(w, return_inverse=True)[1]], seen_h[np.unique(h, return_inverse=True)[1]]


def _pair_sums(rows):
    """Totals of all pairs of a bucket, the pair of each request's entries, and how many entries each has."""
    each = [_pair_entries(data) for _, data, _ in rows]
    sizes = [len(e[0]) for e in each]
    h, w, n, seen_w, seen_h = (np.concatenate(x) for x in zip(*each))
    order = np.lexsort((w, h))
    new = np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    one = order[new]
    total = np.zeros(len(one), np.int64)
    np.add.at(total, kind, n)
    return h[one], total, seen_w[one], seen_h[one], kind, sizes


def _pair_counts(words: Words, split: int):
    """Counts of counts of pairs; of contexts that are split also their own."""

    def answer(rows):
        h, total, seen_w, seen_h, _, _ = _pair_sums(rows)
        bucket = rows[0][2]
        r, n = np.unique(total[total > 0], return_counts=True)
        for a, b in zip(r.tolist(), n.tolist()):
            yield 1, bucket, None, None, None, a, b, None
        some = np.flatnonzero((seen_h >= split) & (total > 0))
        p = words(seen_w[some])
        pairs, at = np.unique(np.stack([h[some], total[some]]), axis=1, return_inverse=True)
        for a, b, m, mass in zip(*pairs.tolist(), np.bincount(at.ravel(), minlength=pairs.shape[1]).tolist(), np.bincount(at.ravel(), p, pairs.shape[1]).tolist()):
            yield 2, bucket, None, None, a, b, m, mass

    return answer


def _pair_answers(words: Words, discount: Discount):
    """For each chunk the total of each pair that it asked for, and the backoff weight of the context of unseen ones."""

    def answer(rows):
        given = [unpack(data, 3) for chunk, data, _ in rows if chunk < 0]
        rows = [r for r in rows if r[0] >= 0]
        if not rows:
            return
        h, total, seen_w, seen_h, kind, sizes = _pair_sums(rows)
        contexts, first, at = np.unique(h, return_index=True, return_inverse=True)
        some = np.maximum(total, 1).astype(np.float64)
        freed = np.bincount(at, np.where(total > 0, discount.freed(some) * some, 0.0), len(contexts))
        mass = np.bincount(at, np.where(total > 0, words(seen_w), 0.0), len(contexts))
        for split, f, m in given:
            place = np.searchsorted(contexts, split)
            hit = (place < len(contexts)) & (contexts[np.minimum(place, len(contexts) - 1)] == split)
            freed[place[hit]], mass[place[hit]] = f[hit].view(np.float64), m[hit].view(np.float64)
        alpha = freed / seen_h[first] / np.maximum(1 - mass, words.unseen)
        sent = np.where(total > 0, 0.0, alpha[at])
        edges = np.cumsum([0, *sizes])
        for (chunk, _, bucket), a, b in zip(rows, edges[:-1], edges[1:]):
            yield 0, bucket, chunk, pack(total[kind[a:b]], sent[kind[a:b]]), None, None, None, None

    return answer


def _counts(answers: DataFrame, column: str = "r") -> tuple[list[int], list[int]]:
    """Counts of counts; as many as there are different counts, at most the root of twice the tokens."""
    found = answers.filter("kind = 1").groupBy(column).agg(F.sum("m").alias("m")).orderBy(column).collect()
    return [r[column] for r in found], [r.m for r in found]


def _split_contexts(counts: DataFrame, discount: Discount, buckets: DataFrame) -> DataFrame:
    """Freed counts and mass of the contexts that several buckets share, as a row for each of these buckets."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            r = np.asarray(column(batch, "r"), np.float64)
            m = np.asarray(column(batch, "m"), np.float64)
            yield _batch(list(zip(column(batch, "h").to_pylist(), (discount.freed(r) * r * m).tolist(), column(batch, "b").to_pylist())), "h long, f double, b double")

    sums = counts.filter("kind = 2").groupBy("h", "r").agg(F.sum("m").alias("m"), F.sum("b").alias("b")).mapInArrow(run, "h long, f double, b double")
    sums = sums.groupBy("h").agg(F.sum("f").alias("f"), F.sum("b").alias("b"))

    def packed(table):
        import pyarrow as pa

        h, f, b = (np.asarray(table.column(c)) for c in ("h", "f", "b"))
        return pa.Table.from_batches([_batch([(table.column("bucket")[0].as_py(), -1, pack(h, f, b))], REQUEST)])

    return buckets.join(sums, "h").groupBy("bucket").applyInArrow(packed, REQUEST)


def _with_answers(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Each chunk with what it was answered; a chunk asks a bucket once."""
    for k, rows in enumerate(answers):
        got = rows.filter("kind = 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "data")).alias(f"answers_{k}"))
        chunks = chunks.join(got, "chunk", "left")
    return chunks


def scored(docs: DataFrame, train: Column, keep: list[str] | None = None, text: str = "text", chunk_bytes: int = CHUNK, entries: int = ENTRIES, split: int = SPLIT) -> DataFrame:
    """Rows of ``docs`` (or their columns ``keep``) with n_tokens, n_known, train_tokens, base_score and score under the model of the rows
    for which ``train`` holds (null: not); columns of these names are replaced. Every row counts, repeated ones too.

    base_score is the sum of log10((c + 1) / (N + V + 1)) over the tokens, with N tokens and V kinds in training; n_known counts the tokens
    with c > 0. An empty table gives no rows.
    """
    new = {f.name for f in SCORES}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    if not keep:
        raise ValueError("keep at least one column")
    spark = docs.sparkSession
    kept = [docs.schema[c] for c in keep]
    chunks = written(chunked(docs, keep, text, F.coalesce(train, F.lit(False)), chunk_bytes), "katz-chunks", rows_together=4)
    # From here on rows are large.
    with arrow_rows(spark, 2):
        kinds = int(chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first().n)
        buckets = kinds // entries + 1
        words_found = written(_grouped(_word_requests(chunks, buckets), buckets, _word_answers(buckets), ANSWER), "katz-words", rows_together=4)
        rows = _trained(chunks)
        r, n = _counts(words_found)
        words = Words(*_with_end(r, n, rows))
        # A chunk has fewer pairs than tokens; three times its words is about their number.
        pair_buckets = kinds * 3 // entries + 1

        def ask(batches: Iterator) -> Iterator:
            for row in _rows(batches):
                chunk = Chunk(row, row["answers_0"].as_py() or [], buckets, words, rows)
                asked = list(chunk.requests(row["chunk"].as_py(), pair_buckets, split))
                if asked:
                    yield _batch(asked, REQUEST)

        inputs = _with_answers(chunks.drop("docs", "counts"), words_found)
        requests = written(inputs.mapInArrow(ask, REQUEST), "katz-requests", rows_together=4)
        counts = written(_grouped(requests, pair_buckets, _pair_counts(words, split), ANSWER), "katz-counts")
        discount = Discount(*_counts(counts))
        shared = _split_contexts(counts, discount, counts.filter("kind = 2").select("bucket", "h").distinct())
        every = requests.unionByName(shared)
        pairs_found = written(_grouped(every, pair_buckets, _pair_answers(words, discount), ANSWER), "katz-pairs", rows_together=4)
        dropped(requests)

        schema = StructType([*kept, *SCORES])

        def score(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for row in _rows(batches):
                chunk = Chunk(row, row["answers_0"].as_py() or [], buckets, words, rows)
                tokens, known, base, total = chunk.scores(row["answers_1"].as_py() or [], pair_buckets, split, discount)
                n = len(tokens)
                yield pa.RecordBatch.from_arrays([*row["docs"].values.flatten(), *(pa.array(x) for x in (tokens, known, np.full(n, words.total), base, total))], names=schema.names)

        return written(_with_answers(chunks.drop("counts"), words_found, pairs_found).mapInArrow(score, schema), "katz-scores")


def _trained(chunks: DataFrame) -> int:
    """Training rows."""

    def run(batches: Iterator) -> Iterator:
        for row in _rows(batches):
            yield _batch([(int(unpack(row["train"].as_py(), 1)[0].sum()),)], "n long")

    return int(chunks.select("train").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n)


def _with_end(r: list[int], n: list[int], rows: int) -> tuple[list[int], list[int]]:
    """Counts of counts with the end, which every training row has once."""
    known = dict(zip(r, n))
    if rows:
        known[rows] = known.get(rows, 0) + 1
    return list(known), list(known.values())
