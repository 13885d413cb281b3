"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary itself.

The rank file is turned into a sentencepiece BPE model without training: every token becomes a piece
whose bytes are mapped to printable characters and whose score is its negative rank, and the
normaliser is the identity. Merging the adjacent pair with the best score is then merging the pair
with the lowest rank, and a piece's number is its rank.

Contract: a null text is the empty text and has no ids. Every row gives one row, repeated rows
included; an empty table gives an empty table. Texts may be of any length: the model works on one
match of the pattern at a time, with a heap. Input columns other than the text are handed through as
they are, whatever their names, unless they bear a name of the result, in which case the result's wins.
"""

from __future__ import annotations

import base64
import functools
import struct

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.chunks import Chunks
from tidemark.llm.common import lists, map_rows, own_names


@functools.cache
def byte_letters() -> list[str]:
    """The printable character of each byte: itself if it is a visible Latin-1 character, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in letters]
    letters.update({b: chr(256 + k) for k, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, value: int | bytes | float) -> bytes:
    """One protobuf field: a varint, a 32-bit float or a length with bytes."""
    if isinstance(value, float):
        return _number(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _number(number << 3) + _number(value)
    return _number(number << 3 | 2) + _number(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised model: pieces by rank, scored by negative rank, then the unknown piece.

    Fixed values, from the public model format: pieces are field 1 (piece 1, score 2, type 3), the
    trainer's part is field 2 (model type 3: BPE is 2; vocabulary size 4; unknown id 40, begin 41,
    end 42, padding 43), the normaliser's is field 3 (name 1, dummy prefix 3, extra blanks 4,
    blank escaping 5). Type 1 is a normal piece, 2 the unknown one.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    letters = byte_letters()
    absent = _number((1 << 64) - 1)
    pieces = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        text = "".join(letters[b] for b in token).encode("utf-8")
        pieces.append(_field(1, _field(1, text) + _field(2, float(-rank)) + _field(3, 1)))
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
    for number in (41, 42, 43):
        trainer += _number(number << 3) + absent
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts and decodes ids with the ranks of one file."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.ranks = read_ranks(path)
        self.letters = byte_letters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        back = {letter: byte for byte, letter in enumerate(self.letters)}
        # decoding is the inverse map: a piece's letters back to bytes
        self.tokens = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(self.ranks))]
        self.chunks = Chunks(pattern, self._matches, b"".join)

    def _matches(self, matches: list[str]) -> list[bytes]:
        """Ids of each match, as little-endian 32-bit numbers."""
        letter = self.letters.__getitem__
        raw = [m.encode("utf-8") for m in matches]
        # a match that is itself a token is that token, as in the library, also where no merges lead to it
        whole = [self.ranks.get(r) for r in raw]
        merged = iter(self.model.encode(["".join(map(letter, r)) for r, w in zip(raw, whole) if w is None], num_threads=1))
        return [np.array([w] if w is not None else next(merged), "<u4").tobytes() for w in whole]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.chunks.totals(texts)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker, file and pattern."""
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every text; nothing is shuffled."""
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        code = codec(path, pattern)
        return [batch.column(0), lists(code.encode(batch.column(1).to_pylist()), "int32")]

    return map_rows(own_names(df, {"key": key, "text": text}), work, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``decoded`` (binary) of every list of ids; null ids give no bytes."""
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        code = codec(path, pattern)
        return [batch.column(0), [code.decode(i or []) for i in batch.column(1).to_pylist()]]

    return map_rows(own_names(df, {"key": key, "ids": ids}), work, f"`{key}` {kind}, decoded binary")


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` in one pass over the texts."""
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        code = codec(path, pattern)
        ids = code.encode(batch.column(1).to_pylist())
        return [batch.column(0), lists(ids, "int32"), [code.decode(i.tolist()) for i in ids]]

    schema = f"`{key}` {kind}, ids array<int>, decoded binary"
    return map_rows(own_names(df, {"key": key, "text": text}), work, schema)
