"""Byte-level BPE through a sentencepiece model that is serialised straight from the ranks.

Every byte has a printable character of its own, every token of the vocabulary becomes a piece of such characters with the
negative rank as score, and the normaliser is the identity. sentencepiece then merges the same pairs in the same order as the
ranks ask for. Texts are cut into pre-tokens by the pattern first; decoding maps pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_CACHED = 400_000
#: The unknown piece, in a character that stands for no byte.
UNKNOWN = "\uf8ff"


def byte_characters() -> list[str]:
    """A character for each byte: itself where Latin-1 prints it, else one from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = b""
    n &= 0xFFFFFFFFFFFFFFFF
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_proto(pieces: list[tuple[str, float]]) -> bytes:
    """A sentencepiece BPE ModelProto of these pieces and scores, with one unknown piece behind them and the identity as normaliser."""
    out = bytearray()
    for kind, some in ((1, pieces), (2, [(UNKNOWN, -1e7)])):
        for piece, score in some:
            out += _block(1, _block(1, piece.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))
    n = len(pieces)
    # trainer: BPE, size, ids of unknown and of the absent begin, end and padding pieces
    out += _block(2, _number(3, 2) + _number(4, n + 1) + _number(40, n) + _number(41, -1) + _number(42, -1) + _number(43, -1) + _block(45, UNKNOWN.encode()))
    # normaliser: no prefix, white space left as it is
    out += _block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The ModelProto whose piece ids are the ranks, which must be 0, 1, 2 and so on."""
    chars = byte_characters()
    ordered = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be gapless")
    return model_proto([("".join(chars[b] for b in token), -float(rank)) for rank, token in enumerate(ordered)])


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.pattern = regex.compile(pattern)
        self.to_chars = byte_characters()
        back = {c: b for b, c in enumerate(self.to_chars)}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.ids: dict[str, bytes] = {}  # pre-token to ids, little-endian unsigned 32-bit
        self.text: dict[str, bytes] = {}  # pre-token to its ids in decimal
        self.back: dict[str, bytes] = {}  # pre-token to its decoded ids

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def learn(self, tokens: set[str]) -> None:
        if len(self.ids) > MOST_CACHED:
            for d in (self.ids, self.text, self.back):
                d.clear()
        new = [t for t in tokens if t not in self.ids]
        chars = self.to_chars
        for t, ids in zip(new, self.model.encode(["".join([chars[b] for b in t.encode()]) for t in new], out_type=int, num_threads=1), strict=True):
            self.ids[t] = np.array(ids, "<u4").tobytes()
            self.text[t] = " ".join(map(str, ids)).encode()
            self.back[t] = self.decode(ids)

    def encode(self, text: str) -> np.ndarray:
        tokens = self.split(text)
        self.learn(set(tokens))
        return np.frombuffer(b"".join(map(self.ids.__getitem__, tokens)), "<u4")

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    key = (ranks_path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def _digest(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            n, ids, back = [], [], []
            for text in batch.column(1).to_pylist():
                tokens = c.split(text or "")
                c.learn(set(tokens))
                decimal = b" ".join(map(c.text.__getitem__, tokens))
                n.append(decimal.count(b" ") + 1 if decimal else 0)
                ids.append(hashlib.sha256(decimal).hexdigest())
                back.append(hashlib.sha256(b"".join(map(c.back.__getitem__, tokens))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encode(path: str, pattern: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            found = [c.encode(t or "").astype(np.int32) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "ids"])

    return run


def _decode(path: str, pattern: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            found = [None if x is None else c.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs and ids (array of int; a column of that name is replaced): the tokens of each whole text, none for null and empty ones."""
    docs = (docs.drop("ids") if text_col != "ids" else docs).withColumn(text_col, F.col(text_col).cast("string"))
    return docs.mapInArrow(_encode(ranks_path, pattern, docs.columns.index(text_col)), T.StructType(list(docs.schema.fields)).add("ids", T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """encoded and decoded (binary; replaced if there): the bytes of the tokens; null for null."""
    encoded = encoded.drop("decoded") if ids_col != "decoded" else encoded
    return encoded.mapInArrow(_decode(ranks_path, pattern, encoded.columns.index(ids_col)), T.StructType(list(encoded.schema.fields)).add("decoded", "binary"))


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: its id, n_tokens (long), and the SHA-256 of its ids in decimal, joined by one space, and of the bytes that they decode to.

    Encodes and decodes each distinct pre-token of a task once. Null texts are empty: no tokens, the digests of no bytes.
    Texts of any length are read whole, one pre-token at a time; equal texts have equal digests. Rows that share an id, or have none,
    have a row each; an empty table gives an empty one. Extra columns are ignored."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([plain.schema["id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return plain.mapInArrow(_digest(ranks_path, pattern), schema).withColumnRenamed("id", id_col)
