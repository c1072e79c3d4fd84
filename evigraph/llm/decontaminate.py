"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 9).

The test strings are the windows of 13 words of the benchmark items (a shorter item is one window). Strings of
one length share a table: the last two words under the search position tell how far it may move without
missing an occurrence; where that is zero, the strings with this suffix are compared in full.

Nulls and texts without words have no words and no windows. An item without an id marks words but is not
listed. Repeated rows are judged one by one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField

from .arrow import column, releasing, with_computed

#: Lower case for A-Z, and a space for each ASCII character that is no letter or digit.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

#: Words of benchmark text, each the start of a test string, that are searched for at once (some 200 MB of tables); more
#: is searched for in several passes.
BLOCK_WORDS = 500_000


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


class Strings:
    """Test strings of one length."""

    def __init__(self, found: dict[tuple[bytes, ...], set]):
        self.length = len(next(iter(found)))
        self.block = min(2, self.length)
        self.far = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.suffixes: dict[tuple[bytes, ...], dict] = defaultdict(dict)
        for string, items in found.items():
            self.suffixes[string[-self.block :]][string] = items
            for end in range(self.block, self.length + 1):
                key = string[end - self.block : end]
                self.shift[key] = min(self.length - end, self.shift.get(key, self.far))

    def search(self, text: list[bytes], spans: list[tuple[int, int]], items: set) -> None:
        """Add the occurrences in ``text`` and the items that they belong to."""
        at, block, length, far, shift = self.length, self.block, self.length, self.far, self.shift.get
        n = len(text)
        while at <= n:
            key = tuple(text[at - block : at])
            step = shift(key, far)
            if not step:
                owners = self.suffixes[key].get(tuple(text[at - length : at]))
                if owners is not None:
                    spans.append((at - length, at))
                    items.update(owners)
                step = 1
            at += step


def strings(rows: list[tuple[str | None, str | None]], window: int) -> list[Strings]:
    """Tables of the windows of items (id, text), one for each length."""
    by_length: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        item_words = words(text)
        size = min(window, len(item_words))
        for k in range(len(item_words) - size + 1 if size else 0):
            owners = by_length[size][tuple(item_words[k : k + size])]
            if item is not None:
                owners.add(item)
    return [Strings(found) for found in by_length.values()]


def _covered(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


FOUND = [StructField("hit_spans", ArrayType(LongType())), StructField("hit_items", ArrayType(StringType()))]
VERDICT = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()), StructField("items_sha256", StringType()), StructField("contaminated", BooleanType())]


def with_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, keep: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (or its columns ``keep``) with hit_spans (word positions from, to, from, to ...), hit_items, n_words,
    n_hit, n_items, items_sha256 and contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    The strings of at most about ``block_words`` words of items are broadcast; a larger benchmark is split into blocks,
    searched for one after another, each pass adding to what the earlier ones found. A longer item is cut into pieces
    that overlap by a window less one word.
    """
    piece = max(window, min(block_words, 10_000))

    def pieces(batches):
        import pyarrow as pa

        for batch in batches:
            ids, texts, sizes = [], [], []
            for item, text in zip(column(batch, "item_id").to_pylist(), column(batch, "text").to_pylist()):
                item_words = words(text)
                for at in range(0, max(1, len(item_words) - window + 1), piece - window + 1):
                    ids.append(item)
                    texts.append(b" ".join(item_words[at : at + piece]).decode())
                    sizes.append(min(piece, len(item_words) - at))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=["item_id", "text", "size"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    items = items.mapInArrow(releasing(pieces), "item_id string, text string, size long")
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    wanted = docs.columns if keep is None else keep
    found = docs
    for block in range(blocks):
        rows = [(r.item_id, r.text) for r in items.filter(number == block).collect()]
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        first, last = block == 0, block == blocks - 1

        def make(shared=shared, first=first, last=last):
            import pyarrow as pa

            tables = strings(shared.value, window)

            def compute(batch):
                texts = column(batch, "text").to_pylist()
                spans = [[] if first else list(zip(s[::2], s[1::2])) for s in ([None] * len(texts) if first else column(batch, "hit_spans").to_pylist())]
                owners = [set() if first else set(x) for x in ([None] * len(texts) if first else column(batch, "hit_items").to_pylist())]
                n_words = []
                for text, s, o in zip(texts, spans, owners):
                    text_words = words(text)
                    n_words.append(len(text_words))
                    for table in tables:
                        table.search(text_words, s, o)
                listed = [sorted(o) for o in owners]
                out = [pa.array([[x for span in s for x in span] for s in spans], pa.list_(pa.int64())), pa.array(listed, pa.list_(pa.string()))]
                if last:
                    n_hit = np.array([_covered(s) for s in spans], np.int64)
                    n = np.array(n_words, np.int64)
                    digest = [hashlib.sha256(",".join(o).encode()).hexdigest() for o in listed]
                    out += [pa.array(n), pa.array(n_hit), pa.array([len(o) for o in listed], pa.int64()), pa.array(digest), pa.array((n_hit > 0) & (20 * n_hit >= n))]
                return out

            return compute

        columns = [c for c in wanted if c not in {f.name for f in VERDICT}] if last else [*docs.columns]
        found = with_computed(found, FOUND + VERDICT * last, make, keep=columns, read=[] if first else [f.name for f in FOUND])
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    names = docs.columns
    own = [F.col(f"`{c}`").alias(c if c == "text" else f"own_{c}") for c in names]
    clean = with_contamination(docs.select(*own), benchmark, window).filter(~F.col("contaminated"))
    return clean.select(*(F.col("text" if c == "text" else f"`own_{c}`").alias(c) for c in names))
