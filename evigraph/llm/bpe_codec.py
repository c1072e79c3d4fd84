"""Byte-level BPE through a sentencepiece model made from a rank file (operator 10).

The model has a piece for each token, its bytes mapped to printable characters, scored by its negative rank;
the unknown piece comes last, so that a piece's id is its rank. Normalisation is the identity.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .arrow import SLICE, bounded_batches, plain_names, releasing
from .pretokens import CachedEncoder
from .storage import slices


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes by rank file line: base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float | str) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def serialized_model(ranks: dict[bytes, int]) -> bytes:
    """The protocol-buffer bytes of the sentencepiece BPE model with these ranks."""
    chars = byte_characters()
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0 to n - 1")
    # Field numbers of the public model format: ModelProto pieces 1 (piece 1, score 2, type 3), trainer_spec 2
    # (model_type 3 = 2 for BPE, vocab_size 4, unk_id 40, bos_id 41, eos_id 42, pad_id 43), normalizer_spec 3
    # (name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5); piece type 2 is unknown.
    pieces = [_field(1, _field(1, "".join(chars[b] for b in token)) + _field(2, float(-rank))) for rank, token in enumerate(tokens)]
    pieces.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)))
    none = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + _field(41, none) + _field(42, none) + _field(43, none)
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBPE:
    """Encodes texts by a rank file and decodes ids; a pre-token that is a token is one id."""

    def __init__(self, path: str):
        import public_tokenizers
        import sentencepiece

        ranks = read_ranks(path)
        chars = byte_characters()
        model = sentencepiece.SentencePieceProcessor(model_proto=serialized_model(ranks))
        mapped = str.maketrans({chr(b): c for b, c in enumerate(chars)})

        def encode(pieces: list[str]) -> list[list[int]]:
            data = [p.encode() for p in pieces]
            rest = [d for d in data if d not in ranks]
            ids = iter(model.encode([d.decode("latin-1").translate(mapped) for d in rest], out_type=int, num_threads=1))
            return [[ranks[d]] if d in ranks else next(ids) for d in data]

        self.encoder = CachedEncoder(public_tokenizers.PATTERN, encode)
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column, and how many each text has."""
        return self.encoder.encode(column)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens in order."""
        size = self.size[ids]
        ends = np.cumsum(size)
        shift = np.repeat(self.start[ids] - ends + size, size)
        return self.bytes[shift + np.arange(len(shift))]

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.size[ids]


def _coded(docs: DataFrame, ranks: str, schema: str, row) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = ByteBPE(ranks)
        at = names.index("text")
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                ids, n = codec.encode(batch.column(at))
                ends = np.concatenate([[0], np.cumsum(n)])
                edges = np.concatenate([[0], np.cumsum(codec.sizes(ids))])[ends].tolist()
                plain = codec.decode(ids).tobytes()
                yield row(pa, batch, ids, ends, [plain[a:b] for a, b in zip(edges, edges[1:])])

    return bounded_batches(docs).mapInArrow(releasing(run), schema)


def encoded_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes, for each row of ``docs``.

    A null text counts as empty; rows that repeat a doc_id each give a row; other columns are not read.
    """

    def row(pa, batch, ids, ends, decoded):
        hexes = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
        data = memoryview(ids.astype("<u4").tobytes())
        parts = [data[4 * a : 4 * b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), hexes(parts), hexes(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _coded(docs.select("doc_id", "text"), ranks, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row)


def round_tripped(docs: DataFrame, ranks: str) -> DataFrame:
    """``docs`` with its text decoded from its ids and two more columns, token_ids and n_tokens.

    Nulls stay null and have no ids. Bytes that are no UTF-8 cannot arise, as ids are those of a string.
    """
    columns = [c for c in docs.columns if c not in ("token_ids", "n_tokens")]
    kept, _ = plain_names(docs, columns)
    schema = kept.schema
    names = [*schema.names, "token_ids", "n_tokens"]

    def row(pa, batch, ids, ends, decoded):
        at = schema.names.index("text")
        columns = list(batch.columns)
        there = columns[at].is_valid().to_pylist()
        columns[at] = pa.array([d.decode() if t else None for t, d in zip(there, decoded)], columns[at].type)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([*columns, lists, pa.array(np.diff(ends))], names=names)

    full = StructType([*schema.fields, StructField("token_ids", ArrayType(IntegerType())), StructField("n_tokens", LongType())])
    return _coded(kept, ranks, full, row).toDF(*columns, "token_ids", "n_tokens")
