"""Encoding of whole texts, each distinct stretch between spaces once.

The split pattern never joins a character with white space after it, a letter or digit with punctuation after it, or
a line feed with a character other than white space after it. A text may therefore be cut before a space or line feed
that another character follows, before ASCII punctuation after an ASCII letter or digit, and after a line feed that no
white space follows; each stretch has the same pre-tokens as in its text.
"""

from __future__ import annotations

import itertools
import re
import string
from collections.abc import Callable

import numpy as np

from .wordhash import SpanTable, gather, text_bytes

_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x0A]] = True
_WORD, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_WORD[list((string.ascii_letters + string.digits).encode())] = True
_PUNCTUATION[list(string.punctuation.encode())] = True
#: Bytes that are, or may begin, white space.
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def stretches(data: np.ndarray, offsets: np.ndarray, edges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the stretches of all texts, and the number of the first stretch of each text and after the last.
    ``edges`` are from, to, from, to ... of parts that are stretches by themselves, as if a text ended before and after."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        solid = ~_SPACE[data[1:]]
        cut[: len(data) - 1] = _CUT[data[:-1]] & solid
        cut[1 : len(data)] |= _WORD[data[:-1]] & _PUNCTUATION[data[1:]] | (data[:-1] == 0x0A) & solid
    for a, b in zip(*(edges.reshape(-1, 2).T.tolist() if edges is not None else ([], []))):
        cut[a:b] = False
    edges = offsets if edges is None else np.concatenate([offsets, edges])
    cut[np.maximum(edges - 1, 0)] = False  # a text's last byte
    cut[edges] = True
    cut[len(data)] = False
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


class CachedEncoder:
    """``encode_pieces`` gives the numbers of each of a list of pre-tokens. A string of ``added`` is one number wherever
    it occurs; texts are split there before anything else (the leftmost first, of those the longest)."""

    def __init__(self, pattern: str, encode_pieces: Callable[[list[str]], list[list[int]]], dtype=np.uint32, added: dict[bytes, int] | None = None):
        import regex

        self.find = regex.compile(pattern).findall
        self.encode_pieces = encode_pieces
        self.added = added or {}
        self.find_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))).finditer
        self.table = SpanTable(self._compute, dtype)

    def _pieces(self, stretch: str) -> list[str]:
        """Pre-tokens; letters need no pattern, nor do they after a space."""
        if (stretch[1:] if stretch[0] == " " else stretch).isalpha():
            return [stretch]
        return self.find(stretch)

    def _compute(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        split = [[] if span in self.added else self._pieces(span.decode()) for span in spans]
        numbers = self.encode_pieces([piece for pieces in split for piece in pieces])
        if len(numbers) != len(split) or self.added:
            each = iter(numbers)
            numbers = [next(each) if len(pieces) == 1 else [n for _ in pieces for n in next(each)] or [self.added[span]] for pieces, span in zip(split, spans)]
        sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
        return np.fromiter(itertools.chain.from_iterable(numbers), self.table.dtype, int(sizes.sum())), sizes

    def _added_edges(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray | None:
        """Where added strings begin and end within their texts."""
        whole = data.tobytes() if self.added else b""
        if not any(map(whole.__contains__, self.added)):
            return None
        texts = zip(offsets.tolist(), offsets[1:].tolist())
        return np.array([a + edge for a, b in texts for m in self.find_added(whole[a:b]) for edge in m.span()], np.int64)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts of an Arrow column, and how many each text has."""
        data, offsets = text_bytes(column)
        starts, first = stretches(data, offsets, self._added_edges(data, offsets))
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        at, size = self.table.look_up(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(size)])
        return gather(self.table.store, at, size), np.diff(total[first])
