"""Language identification by cross-parsing entropy (operator 4).

A suffix automaton for each language holds labelled text. A text is parsed against it into phrases, each the
longest match that starts where the last one ended; ``phrases * log2(length of the labelled text)`` estimates
the bits that the language needs, and the language that needs fewest wins. A text is parsed as one: all pieces of
PIECE symbols of a batch advance together, one table look-up a symbol, and a piece whose guessed first state turns out
wrong is parsed again from the state in which the one before it ended, until it meets the states it had.

Symbols are bytes of the lower-cased text: letters a-z and bytes above 127 that the labelled text has; other
such bytes are one more symbol, and a run of anything else is a space.

The labelled text of a language is a bounded sample of its rows: the whole texts of TRAIN_DOCUMENTS documents of at most
TRAIN_CHARS characters, chosen by a hash of their id (longer ones, the shortest first, only where a language has too few
of these). More than LANGUAGES labels are an error. Predictions read whole texts. A text that is null or has no letter
is ``und`` with score 0. Ties go to the language first in order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from .arrow import column, with_computed
from .wordhash import text_bytes

TRAIN_DOCUMENTS, TRAIN_CHARS, LANGUAGES = 24, 1_200, 200
PIECE = 512


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, documents: int = TRAIN_DOCUMENTS, chars: int = TRAIN_CHARS) -> dict[str, bytes]:
    """The texts of ``documents`` labelled rows of each language, joined. Only these come to the driver."""
    known = docs.select("lang", "doc_id", "text").filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    size = F.length("text")
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))
    # Short texts before long ones; of a language Spark keeps no more than ``documents`` ids in a task before the exchange.
    order = Window.partitionBy("lang").orderBy("size", "draw", "doc_id")
    ids = known.filter("doc_id is not null").select("lang", "doc_id", F.when(size > chars, size).otherwise(0).alias("size"), draw.alias("draw"))
    chosen = ids.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= documents).select("lang", "doc_id").distinct().limit(documents * LANGUAGES + 1).collect()
    if len(chosen) > documents * LANGUAGES or len({r.lang for r in chosen}) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages are labelled")
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, known.select("lang", "doc_id").schema))
    rows = known.join(wanted, ["lang", "doc_id"], "left_semi").distinct().collect() if chosen else []
    texts: dict[str, list[str]] = {}
    for r in sorted(rows):
        texts.setdefault(r.lang, []).append(r.text)
    return {lang: "\n".join(parts).lower().encode() for lang, parts in texts.items()}


class Automaton:
    """The suffix automaton of a sequence of symbols as one table: next state, and END where a phrase ends."""

    END = 1 << 31

    def __init__(self, symbols: np.ndarray, alphabet: int):
        edges: list[dict[int, int]] = [{}]
        link, size = [-1], [0]
        last = 0
        for c in symbols.tolist():
            new = len(edges)
            edges.append({})
            size.append(size[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and c not in edges[state]:
                edges[state][c] = new
                state = link[state]
            if state >= 0:
                target = edges[state][c]
                if size[target] == size[state] + 1:
                    link[new] = target
                else:
                    copy = len(edges)
                    edges.append(dict(edges[target]))
                    size.append(size[state] + 1)
                    link.append(link[target])
                    while state >= 0 and edges[state].get(c) == target:
                        edges[state][c] = copy
                        state = link[state]
                    link[target] = link[new] = copy
            last = new
        # A symbol without an edge ends the phrase and starts the next one from the root; one that the text
        # lacks is a phrase by itself, after which the extra last state ends it.
        start = np.array([edges[0].get(c, len(edges)) * alphabet for c in range(alphabet)], np.uint32)
        table = np.tile(start | np.uint32(self.END), (len(edges) + 1, 1))
        for state, row in enumerate(edges):
            for c, target in row.items():
                table[state, c] = target * alphabet
        self.table = table.reshape(-1)
        self.start = len(edges) * alphabet
        self.bits = float(np.log2(max(2, len(symbols))))


class Parser:
    """Automata of all languages over one set of symbols."""

    def __init__(self, sample: tuple[tuple[str, bytes], ...]):
        self.langs = [lang for lang, _ in sample]
        seen = np.unique(np.frombuffer(b"".join(text for _, text in sample), np.uint8))
        self.symbol = np.zeros(256, np.uint8)
        self.symbol[128:] = 1
        letters = [*range(0x61, 0x7B), *(b for b in seen.tolist() if b >= 128)]
        self.symbol[letters] = np.arange(2, 2 + len(letters))
        self.alphabet = 2 + len(letters)
        self.automata = []
        for _, text in sample:
            data = np.frombuffer(text, np.uint8)
            symbols, _ = self.symbols(data, np.array([0, len(data)]))
            self.automata.append(Automaton(symbols, self.alphabet))

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of spaces as one, and the texts' offsets in them."""
        symbols = self.symbol[data]
        keep = symbols > 0
        keep[1:] |= symbols[:-1] > 0
        kept = np.concatenate([[0], np.cumsum(keep)])
        return symbols[keep], kept[offsets]

    def phrases(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language; a text's last phrase counts."""
        size = np.diff(offsets)
        pieces = -(-size // PIECE)
        owner = np.repeat(np.arange(len(size)), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[:-1][owner] + within * PIECE
        length = np.minimum(PIECE, offsets[1:][owner] - start)
        out = np.zeros((len(size), len(self.automata)))
        if not len(owner):
            return out
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        # Where each piece's text goes on, by place in the order; -1 at its end.
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        after = np.full(len(order), -1)
        going_on = np.flatnonzero(within[1:] > 0)
        after[place[going_on]] = place[going_on + 1]
        padded = np.concatenate([symbols, np.zeros(PIECE, np.uint8)]).astype(np.uint32)
        for k, automaton in enumerate(self.automata):
            ends = self._piece_ends(automaton, padded, start, length, after)
            out[:, k] = np.bincount(owner[order], weights=ends, minlength=len(size))
        return out

    @staticmethod
    def _piece_ends(automaton: Automaton, padded: np.ndarray, start: np.ndarray, length: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Phrases that begin in each piece, pieces longest first; the text of one goes on in piece ``after``."""
        table, mask, top = automaton.table, np.uint32(Automaton.END - 1), np.uint32(31)
        live = np.searchsorted(-length, -np.arange(int(length[0])), side="left")  # pieces longer than t
        # From the last state, every first symbol begins a phrase.
        entry = np.full(len(start), automaton.start, np.uint32)
        state, ends = entry.copy(), np.zeros(len(start), np.uint16)
        states, counts = np.zeros((len(live), len(start)), np.uint32), np.zeros((len(live), len(start)), np.uint16)
        for t, n in enumerate(live.tolist()):
            step = table[state[:n] + padded[start[:n] + t]]
            ends[:n] += (step >> top).astype(np.uint16)
            state[:n] = step & mask
            states[t, :n], counts[t, :n] = state[:n], ends[:n]
        before = np.flatnonzero(after >= 0)
        while True:
            wrong = before[state[before] != entry[after[before]]]
            if not len(wrong):
                return ends
            again = after[wrong]
            entry[again] = state[wrong]
            now, found = entry[again].copy(), np.zeros(len(again), np.uint16)
            t = 0
            while len(again):
                step = table[now + padded[start[again] + t]]
                found += (step >> top).astype(np.uint16)
                now = step & mask
                met = now == states[t, again]
                states[t, again] = now
                old = counts[t, again]
                counts[t, again] = found
                over = length[again] == t + 1
                # From where the states meet the rest of the piece has the same phrases as before.
                done = again[met & ~over]
                shift = (found - old)[met & ~over]
                ends[done] += shift
                for piece, by in zip(done[shift != 0].tolist(), shift[shift != 0].tolist()):
                    counts[t + 1 : length[piece], piece] += np.uint16(by)
                ends[again[over]], state[again[over]] = found[over], now[over]
                go = ~(met | over)
                again, now, found = again[go], now[go], found[go]
                t += 1


FIELDS = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]


def with_language(docs: DataFrame, labelled: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred and score, learnt from ``labelled(doc_id, text, lang)``.

    The score, 0 to 1, is the share by which the second language needs more bits than the first. Without any
    labelled text every prediction is ``und``.
    """
    sample = tuple(sorted(labelled_sample(labelled).items()))
    shared = docs.sparkSession.sparkContext.broadcast(sample)  # at most TRAIN_DOCUMENTS texts a language, LANGUAGES languages

    def make():
        import pyarrow as pa
        import pyarrow.compute as pc

        if not shared.value:
            return lambda batch: [pa.array(["und"] * len(batch)), pa.array(np.zeros(len(batch)))]
        parser = Parser(shared.value)  # for each task, so that workers don't keep it
        names = np.array(parser.langs, object)
        bits = np.array([a.bits for a in parser.automata])

        def compute(batch):
            text = column(batch, "text")
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            symbols, offsets = parser.symbols(*text_bytes(pc.utf8_lower(text)))
            cost = parser.phrases(symbols, offsets) * bits
            best = cost.argmin(axis=1)
            ordered = np.sort(cost, axis=1)
            second = ordered[:, 1] if cost.shape[1] > 1 else np.full(len(cost), np.inf)
            with np.errstate(invalid="ignore", divide="ignore"):
                score = np.where(letters & (second > 0), 1 - ordered[:, 0] / second, 0.0)
            return [pa.array(np.where(letters, names[best], "und"), pa.string()), pa.array(score)]

        return compute

    return with_computed(docs, FIELDS, make, keep)


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with ``lang`` filled in where it was null. Languages are learnt from
    the labels of ``docs``. Rows whose text is null or has no letter go. Without any label no language is known: rows
    with letters stay as they are."""
    names = docs.columns
    own = docs.select(*(F.col(f"`{c}`").alias(c if c == "text" else f"own_{c}") for c in names))
    found = with_language(own, docs).filter(F.col("text").rlike(r"\p{L}"))
    columns = {c: F.col(c if c == "text" else f"`own_{c}`") for c in names}
    columns["lang"] = F.coalesce(columns["lang"], F.nullif("lang_pred", F.lit("und")))
    return found.select(*(columns[c].alias(c) for c in names))
