"""Byte-level BPE through sentencepiece, without any training.

The rank file is serialised as a sentencepiece BPE model: the piece of id N is
the token of rank N with each byte mapped to a character of its own, its score is
-N, and the normaliser is the identity. Texts are cut by the pre-token pattern; a
pre-token that is a token itself gets its rank, any other one is merged by
sentencepiece, whose best-score-first merges are the lowest-rank-first merges of
the rank file. Decoding maps ids to bytes.

Defined results: a null or empty text has no ids. Rows repeat as in the input;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NORMAL, UNKNOWN = 1, 2
BPE = 2
#: Byte b is the character at this code point plus b: letters that nothing normalises or splits.
FIRST_CHARACTER = 0x4E00
MEMO = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank; ranks must be 0, 1, 2 and so on, each once."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(pairs))):
        raise ValueError("ranks aren't consecutive")
    return [ranks[i] for i in range(len(ranks))]


_CHARACTERS = {b: FIRST_CHARACTER + b for b in range(256)}


def piece(token: bytes) -> str:
    return token.decode("latin-1").translate(_CHARACTERS)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: a varint, a float or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece ModelProto of ``tokens``; the last id is <unk>, which no text reaches."""
    pieces = [_field(1, piece(t).encode()) + _field(2, float(-rank)) + _field(3, NORMAL) for rank, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    none = (1 << 64) - 1  # -1: the model has no such id
    trainer = _field(3, BPE) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(_field(n, none) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        self.tokens = read_ranks(path)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.find = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}

    def _ids(self, pre_tokens: list[str]) -> list[bytes]:
        raw = [t.encode() for t in pre_tokens]
        ids = [self.rank.get(r) for r in raw]
        merged = iter(self.model.encode([piece(r) for r, own in zip(raw, ids, strict=True) if own is None], num_threads=1))
        listed = ([own] if own is not None else next(merged) for own in ids)
        return [struct.pack(f"<{len(own)}I", *own) for own in listed]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        pre_tokens = self.find(text)
        out = list(map(self.memo.get, pre_tokens))
        if None in out:
            new = list({t for t, ids in zip(pre_tokens, out, strict=True) if ids is None})
            learnt = dict(zip(new, self._ids(new), strict=True))
            out = [learnt[t] if ids is None else ids for t, ids in zip(pre_tokens, out, strict=True)]
            if len(self.memo) + len(learnt) > MEMO:
                self.memo.clear()
            self.memo.update(islice(((t, ids) for t, ids in learnt.items() if len(t) <= 64), MEMO))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_OPEN: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a process."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = Codec(path, pattern)
    return _OPEN[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids`` (little-endian unsigned 32-bit) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([own.encode(t) for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, and ``decoded``: the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([own.decode(x) for x in ids], pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")
