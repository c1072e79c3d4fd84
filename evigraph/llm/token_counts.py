"""Token counts by a unigram model over a trie (operator 5).

Pre-tokens are words between ASCII white space, with the word mark before them. A task keeps one trie of the
distinct pre-tokens it has met. The forward score of a node (the best sum of piece scores over its prefix) and
the number of pieces on that path come from its ancestors, once for all pre-tokens that share the prefix; the
count at a pre-token's last node is its token count.

The public vocabulary file ranks its pieces; their log-probabilities follow Zipf's law, -log(rank + 2). A
character that no piece covers counts as its UTF-8 bytes. Ties go to fewer tokens, then to the longer last
piece. A null or blank text has no tokens.
"""

from __future__ import annotations

import collections
import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from .arrow import column, with_computed
from .wordhash import SpanTable, text_bytes

MARK = "▁"
UNKNOWN = -30.0
LONG = 200


@functools.lru_cache(2)
def piece_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model file with their scores; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(normal)}


class Trie:
    """Forward scores and token counts by prefix."""

    def __init__(self, scores: dict[str, float], most_nodes: int = 400_000):
        self.scores, self.longest, self.most = scores, max(map(len, scores), default=1), most_nodes
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]

    def _scored(self, word: str) -> int:
        """The token count of a pre-token that is not inserted: only the last scores that a piece reaches are held."""
        scores, longest = self.scores, self.longest
        held = collections.deque([(0.0, 0)], maxlen=longest)  # of the prefixes that end before a character
        for end, char in enumerate(word, 1):
            best, count = held[-1]
            top = (best + UNKNOWN, -count - len(char.encode()))
            for back, (best, count) in enumerate(reversed(held), 1):
                score = scores.get(word[end - back : end])
                if score is not None:
                    top = max(top, (best + score, -count - 1))
            held.append((top[0], -top[1]))
        return held[-1][1]

    def tokens(self, word: str) -> int:
        """Insert a pre-token; its token count. One of over LONG characters is not inserted, as it would fill the trie."""
        if len(word) > LONG:
            return self._scored(word)
        if len(self.best) > self.most:
            self.clear()
        node, path = 0, [0]
        for end, char in enumerate(word, 1):
            known = self.child.get((node, char))
            if known is None:
                size = len(char.encode())
                top = (self.best[node] + UNKNOWN, -self.count[node] - size)
                for start in range(max(0, end - self.longest), end):
                    score = self.scores.get(word[start:end])
                    if score is not None:
                        before = path[start]
                        here = (self.best[before] + score, -self.count[before] - 1)
                        if here > top:
                            top = here
                known = self.child[node, char] = len(self.best)
                self.best.append(top[0])
                self.count.append(-top[1])
            node = known
            path.append(node)
        return self.count[node]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts; a word ends with its text."""
    inside = ~_BLANK[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


FIELDS = [StructField("n_pretokens", LongType()), StructField("n_tokens", LongType())]


def with_token_counts(docs: DataFrame, model: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_pretokens and n_tokens of the whole text."""

    def make():
        import pyarrow as pa

        trie = Trie(piece_scores(model))

        def count(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            return np.array([trie.tokens(MARK + span.decode()) for span in spans], np.int32), np.ones(len(spans), np.int64)

        table = SpanTable(count, np.int32)

        def compute(batch):
            data, offsets = text_bytes(column(batch, "text"))
            starts, ends = word_spans(data, offsets)
            at, _ = table.look_up(data, starts, ends)
            total = np.concatenate([[0], np.cumsum(table.store[at], dtype=np.int64)])
            first = np.searchsorted(starts, offsets)
            return [pa.array(np.diff(first)), pa.array(np.diff(total[first]))]

        return compute

    return with_computed(docs, FIELDS, make, keep)
