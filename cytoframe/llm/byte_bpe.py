"""Byte-level BPE through a sentencepiece model that is written straight from a rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame

CACHE = 400_000  # pre-tokens that a worker remembers


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_chars() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model as protocol buffer: pieces in the order of rank, scored by the negative rank.

    Piece i has rank i, the unknown piece comes last. The normaliser is the identity: no prefix, no white
    space handling. Ranks that the file leaves free are filled with unused pieces.
    """
    chars, by_rank = byte_chars(), {r: t for t, r in ranks.items()}
    size = max(by_rank) + 1
    out = bytearray()
    for r in range(size):
        token = by_rank.get(r)
        text = "".join(chars[b] for b in token) if token is not None else f"{r}"
        piece = _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(r)) + _field(3, 1 if token is not None else 5)
        out += _field(1, piece)
    out += _field(1, _field(1, "".encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, size + 1) + _field(40, size) + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class Codec:
    """encode and decode; a pre-token that is itself in the vocabulary is one id, as in the tiktoken library."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.cut = regex.compile(pattern).findall
        self.chars = byte_chars()
        self.bytes = {r: t for t, r in self.ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}

    def piece(self, token: str) -> tuple[int, ...]:
        raw = token.encode("utf-8", "replace")
        if (whole := self.ranks.get(raw)) is not None:
            return (whole,)
        return tuple(self.model.encode("".join(map(self.chars.__getitem__, raw))))

    def encode(self, text: str) -> list[int]:
        tokens, known = self.cut(text), self.known
        if len(known) > CACHE:
            known.clear()
        for new in set(tokens).difference(known):
            known[new] = self.piece(new)
        return [i for t in tokens for i in known[t]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    """One for each worker process."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text; null and empty texts have no ids; repeated rows are kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "ids": [bpe.encode(t or "") for t in batch["text"]]})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInPandas(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the ids and the bytes decoded from them, as digests.

    The ids stay inside the task, which spares their way through Arrow. Null and empty texts have no ids and the
    digests of nothing; texts of any length are encoded whole; repeated rows and null ids are kept, an empty table
    gives none; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"]):
                ids = bpe.encode(text or "")
                rows.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInPandas(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
