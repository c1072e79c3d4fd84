"""Arrow text columns as byte arrays: spans, hashes of all spans at once, and a table of results by span."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Spans of so many bytes fit two numbers.
SHORT = 16
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash factor and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for k, factor in enumerate((_FACTOR, _INVERSE)):
            row = np.full(max(n, 1 << 19), factor)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    wide = str(column.type).startswith("large")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums over all prefixes of byte value times power of the factor; spans are hashed from them."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(len(data))[0], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, by content and length. Patterned bytes can make such hashes collide: they
    choose buckets and places, and never stand for the bytes."""
    inverse = powers(len(sums))[1]
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX)


def gather(store: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``store`` that begin at ``start``, one after another."""
    ends = np.cumsum(size)
    return store[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _heads(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and second eight bytes of each span as numbers; with the size they are all of a span of up to SHORT."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    every = np.ndarray(len(data) + 9, "<u8", buffer=padded, strides=(1,))
    low = every[start] & _MASKS[np.minimum(size, 8)]
    high = every[np.minimum(start + 8, len(data))] & _MASKS[np.clip(size - 8, 0, 8)]
    return low, high


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, alike in all tasks. Each step between bijections depends on eight bytes at once;
    spans of over SHORT bytes get a cryptographic digest, so that no pattern of bytes makes hashes collide."""
    size = end - start
    low, high = _heads(data, start, size)
    found = mixed(mixed(mixed(low + MIX) ^ high) + size.astype(np.uint64) * MIX)
    long = np.flatnonzero(size > SHORT)
    if len(long):
        whole = data.tobytes()
        digests = b"".join(hashlib.blake2b(whole[a:b], digest_size=8).digest() for a, b in zip(start[long].tolist(), end[long].tolist()))
        found[long] = np.frombuffer(digests, np.uint64)
    return found


class SpanTable:
    """Results (rows of numbers) by a span's bytes; ``compute`` is asked for spans not yet held, and gives the numbers of
    all of them and how many each has.

    A slot holds the last span of up to SHORT bytes that fell into it, whole, so that a hit is exact; longer spans are
    keys of a dictionary. The table starts anew when its results, or the bytes of long spans, exceed ``most``: that
    bounds memory, not what is computed.
    """

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, slots: int = 1 << 19, most: int = 1 << 22):
        self.compute, self.dtype, self.shift, self.most = compute, dtype, np.uint64(64 - slots.bit_length() + 1), most
        self.low, self.high, self.length = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.full(slots, -1, np.int8)
        self.start, self.size = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.store, self.used = np.zeros(1 << 16, dtype), 0
        self.long: dict[bytes, tuple[int, int]] = {}
        self.long_bytes = 0

    def _append(self, values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        need = self.used + len(values)
        if need > len(self.store):
            grown = np.zeros(max(need, 2 * len(self.store)), self.dtype)
            grown[: self.used] = self.store[: self.used]
            self.store = grown
        self.store[self.used : need] = values
        start = self.used + np.cumsum(size) - size
        self.used = need
        return start, size

    def _clear(self) -> None:
        self.length[:] = -1
        self.long, self.long_bytes = {}, 0
        self.store, self.used = np.zeros(1 << 16, self.dtype), 0

    def look_up(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size, in ``store``, of the result of each span."""
        if max(self.used, self.long_bytes) > self.most:
            self._clear()
        length = end - start
        low, high = _heads(data, start, length)
        slot = (mixed(mixed(low + MIX) ^ high ^ length.astype(np.uint64)) >> self.shift).astype(np.int64)
        short = length <= SHORT
        at, size = self.start[slot].astype(np.int64), self.size[slot].astype(np.int64)
        missing = np.flatnonzero((self.length[slot] != length) | (self.low[slot] != low) | (self.high[slot] != high))
        if len(missing):
            whole = data.tobytes()
            spans = [whole[a:b] for a, b in zip(start[missing].tolist(), end[missing].tolist())]
            new = list(dict.fromkeys(span for span in spans if span not in self.long))
            new_at, new_size = self._append(*self.compute(new))
            known = dict(zip(new, zip(new_at.tolist(), new_size.tolist())))
            found = np.array([known.get(span) or self.long[span] for span in spans], np.int64)
            at[missing], size[missing] = found[:, 0], found[:, 1]
            for span in new:
                if len(span) > SHORT:
                    self.long[span] = known[span]
                    self.long_bytes += len(span)
            held = missing[short[missing]]
            place = slot[held]
            self.low[place], self.high[place], self.length[place] = low[held], high[held], length[held]
            self.start[place], self.size[place] = at[held], size[held]
        return at, size
