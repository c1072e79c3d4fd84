"""Token-ID output: Simple-8b word-aligned coding of whole texts (operator 8).

File format: a folder of Parquet files. A row is one block of consecutive documents in ascending doc_id:
``part``/``block`` (its place), ``ids_before`` (ids of the part before it), ``doc_ids``, ``n_tokens`` (with
the end id), ``lane_words`` (words per lane) and ``words``. A lane holds LANE ids. A 64-bit word has its
selector in the four high bits and, from the low bits up, COUNTS[selector] ids of BITS[selector] bits.
Selector ESCAPE says that the next word is one id as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe_codec import byte_characters
from .pretokens import CachedEncoder
from .storage import new_path, slices

# Fixed values of the word format: ids in a word, and bits of each, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30)
ESCAPE = 15
LANE = 240
BLOCK_IDS = 1 << 18


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code ids; returns the words and the number of words of each lane of LANE ids.

    All lanes advance together: a step takes, in each lane, the densest selector that its next ids fit.
    The ids past a lane's end count as zeros; an id of over 30 bits takes an escape and a word.
    """
    n = len(ids)
    lanes = -(-n // LANE)
    if not lanes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    grid = np.zeros((lanes, 2 * LANE), np.uint64)
    grid[:, :LANE].flat[:n] = ids
    size = np.minimum(LANE, n - LANE * np.arange(lanes))
    need = np.zeros(grid.shape, np.uint8)
    for bits in sorted(set(BITS)):
        need += grid >= (np.uint64(1) << np.uint64(bits))
    level = {bits: k for k, bits in enumerate(sorted(set(BITS)))}
    choice = np.full((lanes, LANE), ESCAPE, np.uint8)
    # Largest need among the next 2**k ids, then among any number as two such ranges.
    tops = [need]
    while 1 << len(tops) <= LANE:
        step = 1 << (len(tops) - 1)
        last = tops[-1]
        top = last.copy()
        np.maximum(last[:, :-step], last[:, step:], out=top[:, :-step])
        tops.append(top)
    for selector in reversed(range(len(COUNTS))):
        count = COUNTS[selector]
        k = count.bit_length() - 1
        top = np.maximum(tops[k][:, :LANE], tops[k][:, count - (1 << k) : count - (1 << k) + LANE])
        choice[top <= level[BITS[selector]]] = selector
    at = np.zeros(lanes, np.int64)
    live = np.arange(lanes)
    rows, selectors, starts = [], [], []
    counts = np.array([*COUNTS, 1], np.int64)
    while len(live):
        chosen = choice[live, at[live]]
        rows.append(live)
        selectors.append(chosen)
        starts.append(at[live])
        at[live] += counts[chosen]
        live = live[at[live] < size[live]]
    row, selector, start = np.concatenate(rows), np.concatenate(selectors), np.concatenate(starts)
    order = np.argsort(row, kind="stable")
    row, selector, start = row[order], selector[order], start[order]
    wide = 1 + (selector == ESCAPE)
    place = np.cumsum(wide) - wide
    words = np.zeros(int(wide.sum()), np.uint64)
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[place[which]] = np.uint64(ESCAPE) << np.uint64(60)
            words[place[which] + 1] = grid[row[which], start[which]]
            continue
        word = np.full(len(which), np.uint64(s) << np.uint64(60))
        for k in range(COUNTS[s] if BITS[s] else 0):
            word |= grid[row[which], start[which] + k] << np.uint64(k * BITS[s])
        words[place[which]] = word
    return words, np.bincount(row, weights=wide, minlength=lanes).astype(np.int32)


def unpack(words: np.ndarray, lane_words: np.ndarray, n: int) -> np.ndarray:
    """The n ids of a block; every selector's words are decoded at once."""
    ids = np.zeros((len(lane_words), 2 * LANE), np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (selector == ESCAPE).any():  # the word after an escape is an id, whatever its high bits
        for i in np.flatnonzero(selector == ESCAPE):
            if not raw[i]:
                raw[i + 1] = True
        selector[raw] = -1
    lane = np.repeat(np.arange(len(lane_words)), lane_words)
    counts = np.array([*COUNTS, 1, 0], np.int64)[selector]
    start = np.cumsum(counts) - counts
    first = np.cumsum(lane_words) - lane_words
    start -= np.repeat(start[first], lane_words)
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        if s == ESCAPE:
            ids[lane[which], start[which]] = words[which + 1]
        elif s >= 0 and BITS[s]:
            mask = np.uint64((1 << BITS[s]) - 1)
            for k in range(COUNTS[s]):
                ids[lane[which], start[which] + k] = (words[which] >> np.uint64(k * BITS[s])) & mask
    return ids[:, :LANE].reshape(-1)[:n]


def library_encoder(path: str) -> CachedEncoder:
    """Ids by the tokenizers library: its BPE model on each pre-token; the file's added tokens are found in the texts as
    the library finds them when no special tokens are added."""
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    tokenize = library.model.tokenize
    added = {token.content.encode(): number for number, token in library.get_added_tokens_decoder().items()}
    mapped = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})

    def encode(pieces: list[str]) -> list[list[int]]:
        return [[token.id for token in tokenize(piece.encode().decode("latin-1").translate(mapped))] for piece in pieces]

    return CachedEncoder(public_tokenizers.PATTERN, encode, added=added)


BLOCKS = "part int, block int, ids_before long, doc_ids array<long>, n_tokens array<int>, lane_words binary, words binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs(doc_id, text)`` in ascending doc_id and write the blocks to the folder ``path``.

    Null texts count as empty and hold the end id alone; rows of one doc_id follow each other by text.
    """

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = library_encoder(tokenizer)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal block, before, doc_ids, texts, held
            ids = np.concatenate(texts)
            words, lane_words = pack(ids.astype(np.uint64))
            row = {"part": [part], "block": [block], "ids_before": [before], "doc_ids": [doc_ids], "n_tokens": [list(map(len, texts))], "lane_words": [lane_words.tobytes()], "words": [words.tobytes()]}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))
            block, before, doc_ids, texts, held = block + 1, before + len(ids), [], [], 0
            return out

        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                ids, n = encoder.encode(batch.column(1))
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, end_id)  # an end id after each text
                for doc_id, text in zip(batch.column(0).to_pylist(), np.split(ids, (ends + np.arange(1, len(n) + 1))[:-1])):
                    doc_ids.append(doc_id)
                    texts.append(text)
                    held += len(text)
                    if held >= BLOCK_IDS:
                        yield flush()
        if doc_ids:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the folder ``path``: doc_id, start, n_tokens, ids_crc32, in the order that was written.

    Only one total per written part is summed up in one task; blocks are decoded where they are read.
    """

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                n = np.array(row["n_tokens"], np.int64)
                ids = unpack(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["lane_words"], np.int32), int(n.sum())).astype("<u4")
                ends = np.cumsum(n)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * int(b - k) : 4 * int(b)]) for b, k in zip(ends, n)]
                start = row["part_start"] + row["ids_before"] + ends - n
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema(BLOCKS).parquet(path)
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x)
    parts = blocks.groupBy("part").agg(F.sum(total).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    # One row for each written part, so at most the number of shuffle partitions.
    placed = blocks.join(F.broadcast(starts), "part")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of ``docs`` to a new folder of the shared one and read them back, one row per document."""
    spark = docs.sparkSession
    path = new_path(spark, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(spark, path)
