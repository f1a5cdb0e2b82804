"""Operator 1: byte-level BPE encoding and decoding through sentencepiece.

A rank file becomes a sentencepiece BPE model without training: every token's
bytes are written as characters (byte b is the character U+0100 + b), its
score is the negative rank, and normalisation is the identity.  Sentencepiece
then merges the pair with the highest score, leftmost first, which is the
rank order.  Each match of the pre-token pattern is encoded by itself; a match
that is a token as a whole is that token.  Decoding maps ids back to pieces
and characters back to bytes.

Null and empty texts have no ids; texts of any length are encoded whole.
Rows repeat as they come, and extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.chunks import ChunkEncoder

SHIFT = 0x100
_TO_CHARS = {b: SHIFT + b for b in range(256)}
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """``base64(token) rank`` lines to a table."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def to_chars(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARS)


def to_bytes(piece: str) -> bytes:
    return bytes(ord(c) - SHIFT for c in piece)


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        out.append(n & 0x7F | (0x80 if n > 0x7F else 0))
        n >>= 7
        if not n:
            return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised ModelProto whose ids are the ranks; one more id is <unk>."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    out = bytearray()

    def piece(text: str, score: float, kind: int) -> None:
        body = _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)
        out.extend(_block(1, body))

    for rank, token in enumerate(by_rank):
        piece(to_chars(token), -float(rank), _NORMAL)
    piece("<unk>", -float(len(by_rank)), _UNKNOWN)
    trainer = (_number(3, _BPE) + _number(4, len(by_rank) + 1) + _number(40, len(by_rank))
               + _number(41, -1) + _number(42, -1) + _number(43, -1))
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(out + _block(2, trainer) + _block(3, normalizer))


class ByteBpe:
    """Encoder and decoder for one rank file and one pre-token pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        import sentencepiece

        self.ranks = parse_ranks(rank_file)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.table = [to_bytes(self.model.id_to_piece(i)) for i in range(len(self.ranks))]
        self.chunks = ChunkEncoder(regex.compile(pattern).findall, self._encode_tokens)

    def _encode_tokens(self, tokens: list[str]) -> list[bytes]:
        raw = [t.encode() for t in tokens]
        merged = iter(self.model.encode([to_chars(r) for r in raw if r not in self.ranks], num_threads=1))
        ids = [[self.ranks[r]] if r in self.ranks else next(merged) for r in raw]
        return [struct.pack(f"<{len(i)}I", *i) for i in ids]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.chunks.encode(text)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return self.chunks.encode_batch(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, memoryview(ids).cast("I")))


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text: str = "text",
                     key: str = "doc_id") -> DataFrame:
    """(key, ids binary): the ids of every whole text."""
    return _run(docs, rank_file, pattern, text, key, "ids binary",
                lambda bpe, texts: [pa.array(bpe.encode_batch([t or "" for t in texts]), pa.binary())])


def decode_ids(encoded: DataFrame, rank_file: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded binary): the bytes that the ids stand for."""
    return _run(encoded, rank_file, pattern, ids, key, "decoded binary",
                lambda bpe, rows: [pa.array([bpe.decode(r or b"") for r in rows], pa.binary())])


def round_trip(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text, decode its ids, and return digests of both."""

    def digests(bpe: ByteBpe, texts: list) -> list[pa.Array]:
        n, ids_sha, text_sha = [], [], []
        for ids in bpe.encode_batch([t or "" for t in texts]):
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]

    return _run(docs, rank_file, pattern, text, key,
                "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


_SLICE = 256  # texts turned into Python strings at a time


def _run(df: DataFrame, rank_file: str, pattern: str, column: str, key: str, schema: str, work) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))  # one vocabulary, under 1 MB
    kind = df.schema[key].dataType.simpleString()
    names = [key, *(p.strip().split(" ")[0] for p in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), *work(bpe, part.column(1).to_pylist())], names)

    return df.select(F.col(f"`{key}`"), F.col(f"`{column}`")).mapInArrow(run, f"`{key}` {kind}, {schema}")
