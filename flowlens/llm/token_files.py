"""Token ids in binary files, each id in the fewest bits the vocabulary needs.

A file holds fixed blocks of ids, packed without gaps; a footer has the offset of every block, and the id and first token of
every document. Blocks unpack as whole numpy arrays and can be read alone, so any range of ids costs the blocks it touches.

Layout, little-endian: header ``FLTOKENS`` (8 bytes); blocks of 64-bit words; footer arrays: block offsets (u64), document ids
(i64), null flags of document ids (u8), first token of every document (u64, one more for the end); tail: number of documents
and of ids (u64), bits and ids per block (u32), ``FLTOKENS``.

Defined results: null and empty texts give the end id only; a null ``doc_id`` sorts first and is kept; repeated rows are
documents of their own; an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import filesystem, in_id_order, slices, small_batches, write_whole
from flowlens.llm.encoding import WordEncoder, encoder
from flowlens.session import scratch_path

MAGIC = b"FLTOKENS"
#: Ids of a block, a multiple of 64 so that a block is whole 64-bit words for any width.
BLOCK_IDS = 4096
#: Ids a reader holds at a time (a longer document is held alone).
READ_IDS = 1 << 20
_TAIL = np.dtype([("docs", "<u8"), ("ids", "<u8"), ("bits", "<u4"), ("block", "<u4"), ("magic", "S8")])


def bits_for(vocabulary: int) -> int:
    """Fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """64-bit words with the ids in ``bits`` bits each; the number of ids must be a multiple of 64."""
    rows = np.ascontiguousarray(ids, "<u8").reshape(-1, 64)
    words = np.zeros((len(rows), bits), "<u8")
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        words[:, word] |= rows[:, i] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= rows[:, i] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """Inverse of ``pack``."""
    words = words.reshape(-1, bits)
    ids = np.empty((len(words), 64), "<u4")
    mask = np.uint64((1 << bits) - 1)
    for i in range(64):
        word, shift = divmod(i * bits, 64)
        v = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            v = v | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, i] = v & mask
    return ids.ravel()


class TokenFileWriter:
    """Writes one file; documents are added in order."""

    def __init__(self, out, bits: int):
        self.out, self.bits, self.at = out, bits, len(MAGIC)
        self.offsets: list[int] = []
        self.doc_ids: list[int | None] = []
        self.starts = [0]
        self.rest: list[np.ndarray] = []
        self.waiting = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK_IDS:
            self._flush(self.waiting // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.rest)
        self.rest, self.waiting = [ids[n:]], len(ids) - n
        step = BLOCK_IDS * self.bits // 8
        self.offsets += range(self.at, self.at + n // BLOCK_IDS * step, step)
        self.out.write(pack(ids[:n], self.bits).tobytes())
        self.at += n // BLOCK_IDS * step

    def close(self) -> None:
        if self.waiting:
            self.rest.append(np.zeros(-self.waiting % BLOCK_IDS, "<u4"))
            self.waiting += -self.waiting % BLOCK_IDS
            self._flush(self.waiting)
        tail = np.array([(len(self.doc_ids), self.starts[-1], self.bits, BLOCK_IDS, MAGIC)], _TAIL)
        for x in (np.array(self.offsets, "<u8"), np.array([d or 0 for d in self.doc_ids], "<i8"),
                  np.array([d is None for d in self.doc_ids], "u1"), np.array(self.starts, "<u8"), tail):
            self.out.write(x.tobytes())


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        files, path = filesystem(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = np.frombuffer(self.file.read_at(_TAIL.itemsize, size - _TAIL.itemsize), _TAIL)[0]
        if tail["magic"] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.n_docs, self.n_ids, self.bits, self.block = (int(tail[k]) for k in ("docs", "ids", "bits", "block"))
        blocks = -(-self.n_ids // self.block)
        at = size - _TAIL.itemsize - 8 * blocks - 9 * self.n_docs - 8 * (self.n_docs + 1)
        index = self.file.read_at(size - _TAIL.itemsize - at, at)
        self.offsets = np.frombuffer(index, "<u8", blocks)
        self.doc_ids = np.frombuffer(index, "<i8", self.n_docs, 8 * blocks)
        self.no_id = np.frombuffer(index, "u1", self.n_docs, 8 * blocks + 8 * self.n_docs)
        self.starts = np.frombuffer(index, "<u8", self.n_docs + 1, 8 * blocks + 9 * self.n_docs).astype("i8")

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from token ``start`` on; reads only the blocks that hold them."""
        if n <= 0:
            return np.empty(0, "<u4")
        first, last = start // self.block, (start + n - 1) // self.block
        step = self.block * self.bits // 8
        data = self.file.read_at(int(self.offsets[last] - self.offsets[first]) + step, int(self.offsets[first]))
        return unpack(np.frombuffer(data, "<u8"), self.bits)[start - first * self.block :][:n]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1] - self.starts[i]))

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(index, start, ids) of every document, reading about READ_IDS ids at a time."""
        i = 0
        while i < self.n_docs:
            end = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + READ_IDS, "right")) - 1)
            base = int(self.starts[i])
            ids = self.ids(base, int(self.starts[end]) - base)
            for d in range(i, end):
                yield d, int(self.starts[d]), ids[int(self.starts[d]) - base : int(self.starts[d + 1]) - base]
            i = end


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int) -> list[tuple]:
    """Encodes every text and writes one file per range of ``doc_id``; returns (path, documents, ids) in that order.

    The driver receives one row per file, nothing per document. A file gets its name when it is complete and a retried task
    writes the same bytes.
    """
    small_batches(docs.sparkSession)
    bits = bits_for(max(vocabulary, end_id + 1))
    end = np.array([end_id], "<u4")

    def write(batches):
        from pyspark import TaskContext

        path = f"{folder}/tokens-{TaskContext.get().partitionId():06d}.bin"
        first = next(batches, None)
        if first is None:
            return
        words, done = encoder(WordEncoder, tokenizer), {}

        def fill(out):
            import itertools

            writer = TokenFileWriter(out, bits)
            for rows, texts in slices(itertools.chain([first], batches)):
                for doc_id, ids in zip(rows.column(0).to_pylist(), words.encode_all(texts)):
                    writer.add(doc_id, np.concatenate([ids, end]))
            writer.close()
            done.update(docs=len(writer.doc_ids), ids=writer.starts[-1])

        write_whole(path, fill)
        yield pa.RecordBatch.from_pylist([{"path": path, "docs": done["docs"], "ids": done["ids"]}])

    made = in_id_order(docs).mapInArrow(write, "path string, docs long, ids long").collect()
    return sorted((r.path, r.docs, r.ids) for r in made if r.docs)


def read_token_files(spark, written: list[tuple]) -> DataFrame:
    """One row per document, from the files alone: doc_id, start over all files, n_tokens, ids_crc32."""
    rows, base = [], 0
    for path, _, n in written:
        rows.append((path, base))
        base += n

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file, out = TokenFile(path), []
                for i, start, ids in file.documents():
                    doc_id = None if file.no_id[i] else int(file.doc_ids[i])
                    out.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                for k in range(0, len(out), 10_000):
                    columns = [pa.array(c, pa.int64()) for c in zip(*out[k : k + 10_000])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(rows, "path string, base long").repartition(len(rows), F.col("base")).mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, vocabulary: int = 49_408, folder: str | None = None) -> DataFrame:
    """Writes the files below ``folder`` (by default a new one in the session's shared folder) and reads them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, folder or scratch_path(spark, "tokens"), tokenizer, end_id, vocabulary))
