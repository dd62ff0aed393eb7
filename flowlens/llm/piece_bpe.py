"""Byte-level BPE through a sentencepiece model that is written out from a rank file, nothing trained.

Every byte is spelled as one character, every vocabulary entry is a normal piece with score minus its rank, and the model
normalises nothing. The best-scored adjacent pair is then the pair of lowest rank, so encoding one pre-token gives the merges
of the rank file; decoding maps ids back to bytes.

Defined results: null and empty texts give no ids; repeated rows give a row each; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import slices, small_batches, text_of
from flowlens.llm.encoding import Chunks, byte_letters, encode_spaced, encoder, ids_of_spaced, packed, unmarked


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in order of rank."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(entry)) for entry, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [entry for _, entry in pairs]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n & (1 << 64) - 1)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def piece_model(entries: list[bytes]) -> bytes:
    """Serialised sentencepiece model: piece id = rank, one unknown piece after the last."""
    letters, normal, unknown, bpe = byte_letters(), 1, 2, 2

    def piece(spelled: str, score: float, kind: int) -> bytes:
        return _message(1, _message(1, spelled.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("".join(letters[b] for b in e), -float(rank), normal) for rank, e in enumerate(entries)]
    pieces.append(piece("<unk>", 0.0, unknown))
    none = -1
    trainer = _number(3, bpe) + _number(4, len(pieces)) + _number(40, len(entries)) + b"".join(_number(k, none) for k in (41, 42, 43))
    no_change = _message(1, b"identity") + b"".join(_number(k, 0) for k in (3, 4, 5))
    return b"".join(pieces) + _message(2, trainer) + _message(3, no_change)


class PieceEncoder:
    """Ids of whole texts, each match of the pattern encoded separately; ``path`` and pattern are joined by a null byte."""

    def __init__(self, key: str):
        import regex
        import sentencepiece

        path, pattern = key.split("\0")
        self.entries = read_ranks(path)
        self.by_bytes = {e: i for i, e in enumerate(self.entries)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model(self.entries))
        self.find = regex.compile(pattern).findall
        self.letters = byte_letters()
        self.cache, self.spaced = Chunks(self._ids), Chunks(lambda rest: self._ids(" " + rest))
        self.marked = Chunks(lambda chunk: self._ids("".join(unmarked(chunk))))

    def _ids(self, chunk: str) -> bytes:
        ids: list[int] = []
        for token in self.find(chunk):
            data = token.encode()
            whole = self.by_bytes.get(data)
            if whole is not None:
                ids.append(whole)
            else:
                ids += self.pieces.encode("".join(self.letters[b] for b in data))
        return packed(ids)

    def encode(self, text: str) -> bytes:
        return encode_spaced(text, self.cache, self.spaced)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        return ids_of_spaced(texts, self.marked, self.encode)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids (little-endian unsigned 32-bit) and of the decoded bytes."""
    small_batches(docs.sparkSession)
    key = f"{ranks}\0{pattern}"

    def run(batches):
        coder = encoder(PieceEncoder, key)
        for rows, texts in slices(batches):
            n, a, b = [], [], []
            for ids in coder.encode_all(texts):
                n.append(len(ids))
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            columns = [rows.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
