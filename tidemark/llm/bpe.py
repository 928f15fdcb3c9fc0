"""Byte-level BPE through sentencepiece: a BPE model is serialised from the ranks.

Each byte is mapped to one printable character, so a token of the vocabulary is
a piece, and its score is its negative rank: sentencepiece merges the adjacent
pair with the highest score, which is the pair of the lowest rank. The model
normalises nothing. Texts are cut by the pre-token pattern first, each match is
encoded by itself, and ids are decoded by the inverse mapping of their pieces.

Null texts are empty: no ids, and no bytes when decoded. Rows are independent,
so repeated rows, ties of any kind and empty tables need no rule. A column of
the name of the result is replaced, others may have any name. Texts of any length are encoded whole; a task needs some
fifteen times the longest for its pre-tokens.
"""

from __future__ import annotations

import base64
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, with_column

#: Pre-tokens whose ids a worker keeps, and their greatest length in characters.
CACHED = 1 << 17
CACHED_LENGTH = 64

#: Byte b is this far above its code: U+0100 to U+01FF are letters, none is white space.
BYTE_BASE = 0x100
_TO_PIECE = {b: chr(BYTE_BASE + b) for b in range(256)}

# Field numbers and enumeration values of sentencepiece's model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 4, 40, 41, 42, 43
_BPE = 2
_NAME, _DUMMY_PREFIX, _EXTRA_WHITESPACES, _ESCAPE_WHITESPACES = 1, 3, 4, 5


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _nested(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def as_piece(token: bytes) -> str:
    return "".join(map(_TO_PIECE.__getitem__, token))


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the unknown piece comes after them."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without a gap")

    def piece(text: str, score: float, kind: int) -> bytes:
        score_field = _varint(_SCORE << 3 | 5) + struct.pack("<f", score)
        return _nested(_PIECES, _nested(_PIECE, text.encode()) + score_field + _number(_TYPE, kind))

    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, len(tokens) + 1) + _number(_UNK_ID, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (_BOS_ID, _EOS_ID, _PAD_ID))
    off = (_DUMMY_PREFIX, _EXTRA_WHITESPACES, _ESCAPE_WHITESPACES)
    normalizer = _nested(_NAME, b"identity") + b"".join(_number(field, 0) for field in off)
    return b"".join(
        [
            *(piece(as_piece(t), -float(i), _NORMAL) for i, t in enumerate(tokens)),
            piece("<unk>", 0.0, _UNKNOWN),
            _nested(_TRAINER, trainer),
            _nested(_NORMALIZER, normalizer),
        ]
    )


class Codec:
    """Encoder and decoder of one vocabulary in one worker."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = sorted(self.ranks, key=self.ranks.__getitem__)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def _encode_pieces(self, pre_tokens: list[str]) -> list[list[int]]:
        """A pre-token that is a token stays whole, the others are merged by the model."""
        raw = [p.encode() for p in pre_tokens]
        ids = [[self.ranks[r]] if r in self.ranks else None for r in raw]
        merged = iter(self.model.encode([as_piece(r) for r, i in zip(raw, ids) if i is None], num_threads=1))
        return [next(merged) if i is None else i for i in ids]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.split(t) if t else [] for t in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
        here = dict(zip(new, self._encode_pieces(new)))
        known.update((p, i) for p, i in here.items() if len(p) <= CACHED_LENGTH)
        long = {p: i for p, i in here.items() if len(p) > CACHED_LENGTH}
        if not long:
            return [list(chain.from_iterable(map(known.__getitem__, pre_tokens))) for pre_tokens in cut]
        return [[i for p in pre_tokens for i in (known[p] if p in known else long[p])] for pre_tokens in cut]

    def decode(self, ids: list[int] | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids or ()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _lists(ids: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(
    df: DataFrame, path: str, pattern: str, column: str = "text", into: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """``df`` (its columns ``keep``) with the token ids of ``column`` as ``into``.

    ``path`` is the rank file on every machine, ``pattern`` cuts the pre-tokens.
    """
    kept, schema = with_column(df, into, T.ArrayType(T.IntegerType()), keep)

    def each(batch: pa.RecordBatch) -> dict:
        ids = codec(path, pattern).encode(batch.column("__text").to_pylist())
        return {c: batch.column(c) for c in kept} | {into: _lists(ids)}

    return arrow_map(df.select(*kept, F.col(column).alias("__text")), each, schema)


def round_trip(df: DataFrame, path: str, pattern: str, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``ids``, and ``decoded`` from them."""
    kept, with_ids = with_column(df, "ids", T.ArrayType(T.IntegerType()), keep)
    kept = [c for c in kept if c != "decoded"]
    schema = T.StructType([*(df.schema[c] for c in kept), with_ids["ids"], T.StructField("decoded", T.BinaryType())])

    def each(batch: pa.RecordBatch) -> dict:
        one = codec(path, pattern)
        ids = one.encode(batch.column("__text").to_pylist())
        return {c: batch.column(c) for c in kept} | {"ids": _lists(ids), "decoded": list(map(one.decode, ids))}

    return arrow_map(df.select(*kept, F.col(column).alias("__text")), each, schema)


def decode(
    df: DataFrame, path: str, pattern: str, column: str = "ids", into: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """``df`` (its columns ``keep``) with the bytes that the ids in ``column`` stand for as ``into``."""
    kept, schema = with_column(df, into, T.BinaryType(), keep)

    def each(batch: pa.RecordBatch) -> dict:
        one = codec(path, pattern)
        ids = batch.column("__ids")
        return {c: batch.column(c) for c in kept} | {into: [one.decode(i.values.to_numpy().tolist() if i.is_valid else None) for i in ids]}

    return arrow_map(df.select(*kept, F.col(column).alias("__ids")), each, schema)
