"""Alignment of two tokenizers over one corpus: which token of one overlaps which of the other, and in how many documents.

Alignment. Both tokenizers spell out the same bytes, a space and the text, so their tokens are ranges of the same line. Where a
token of either ends at the same byte, a group ends. Two tokens whose ranges overlap are linked. No token of either spans the
place before a space that follows something else, or a newline between two such places, so a text is aligned chunk by chunk;
chunks repeat, and a bounded cache keeps the alignment of those a worker has met.

Counts. The documents lie in blocks by hash. The first pass gives every block its distinct pairs of ids and the number of its
documents that link them. The distinct pairs of the corpus are dealt into shards by hash, and every shard gets a minimal
perfect hash, with its pairs in order of their numbers for verification. A leaf task takes the rows of some blocks for one
shard and adds them into one dense vector of counts, in which a pair stands at its number; vectors are added FAN at a time up a
tree until one is left for a shard. Blocks then ask the shards for the counts of their pairs, by number, verifying the key.
The second pass aligns the documents of a block again beside the counts of its pairs.

A shard, a leaf and a block are of bounded size, whatever the corpus; a pair that all documents hold costs a row a block. The
driver gets one number per id of the first vocabulary, its highest count.

Defined results: a null or empty text has no tokens, nor has one that either tokenizer does not spell out exactly; repeated
rows are documents of their own; null ids stay null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import small_batches, stored_with, text_of
from flowlens.llm.encoding import LATIN_WORD, TWO_SPACES, Chunks, byte_letters, encoder, spaced_chunks
from flowlens.llm.perfect_hash import MinimalHash
from flowlens.session import stored

BLOCK_BYTES = 4 << 20
#: Chunks of a block whose links are spread out at a time.
STEP = 1 << 17
#: Pairs of one shard, about; its vector of counts has as many places.
SHARD_PAIRS = 1 << 15
#: Characters of the chunks a worker remembers; an alignment takes twice the memory of a chunk's ids.
CACHE_CHARS = 3_000_000
#: Rows that a leaf adds into one vector, about, and vectors added at a time above.
LEAF_ROWS, FAN = 1 << 18, 8
_KEY = "\0"
#: A mark behind a letter and before white space: both tokenizers end a token before it.
_MARK_AFTER_WORD = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])(?=[ \n]|$)")
_LETTER_AND_MARK = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]")
#: Stands before a chunk that continues the one before it.
_GOES_ON = "\1"
_APART = _GOES_ON + "\n"


_HEAD = struct.Struct("<4I")
_EMPTY = _HEAD.pack(0, 0, 0, 0)


def aligned(a: list[int], b: list[int], size_a: list[int], size_b: list[int], names: list[str]) -> bytes:
    """Alignment of a chunk in one small object, for the cache: numbers of tokens of either, of groups and of links; the links
    as pairs of ids (first id in the upper half); the groups as text. ``names``: the ids as text.
    """
    if len(a) == 1 or len(b) == 1:
        links = [x << 32 | y for x in a for y in b]
        groups = [",".join([names[x] for x in a]) + "|" + ",".join([names[x] for x in b])]
    else:
        groups, links, i, j, from_a, from_b = [], [], 0, 0, 0, 0
        end_a, end_b, n = size_a[0], size_b[0], len(a)
        while True:
            links.append(a[i] << 32 | b[j])
            if end_a < end_b:
                i += 1
                end_a += size_a[i]
            elif end_b < end_a:
                j += 1
                end_b += size_b[j]
            else:
                i, j = i + 1, j + 1
                groups.append(",".join([names[x] for x in a[from_a:i]]) + "|" + ",".join([names[x] for x in b[from_b:j]]))
                from_a, from_b = i, j
                if i == n:
                    break
                end_a += size_a[i]
                end_b += size_b[j]
    return _HEAD.pack(len(a), len(b), len(groups), len(links)) + array("Q", links).tobytes() + ";".join(groups).encode()


def groups_of(chunk: bytes) -> bytes:
    return chunk[_HEAD.size + 8 * _HEAD.unpack_from(chunk)[3] :]


class Lines:
    """Aligned texts: different chunks, and the chunks of every text by number; a text without tokens has none."""

    def __init__(self, chunks: list[bytes], number: np.ndarray, bounds: list[tuple[int, int]]):
        self.chunks, self.number, self.bounds = chunks, number, bounds
        head = np.frombuffer(b"".join([c[: _HEAD.size] for c in chunks]), "<u4").reshape(-1, 4).astype("i8")
        self.n_a, self.n_b, self.n_groups, self.n_links = head.T
        ends = (_HEAD.size + 8 * self.n_links).tolist()
        self.links = np.frombuffer(b"".join([c[_HEAD.size : e] for c, e in zip(chunks, ends)]), "<i8")

    def sums(self, *of_chunk: np.ndarray) -> list[np.ndarray]:
        """For every text the sums of what its chunks have."""
        at = np.array(self.bounds, "i8").reshape(-1, 2)
        return [(total := np.r_[0, np.cumsum(x[self.number])])[at[:, 1]] - total[at[:, 0]] for x in of_chunk]

    def per_link(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of every chunk."""
        total, ends = np.r_[0, np.cumsum(values)], np.cumsum(self.n_links)
        return total[ends] - total[ends - self.n_links]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Different links, and the number of texts that have each."""
        at = np.array(self.bounds, "i8").reshape(-1, 2)
        text = np.repeat(np.arange(len(at)), at[:, 1] - at[:, 0])
        inside = np.concatenate([self.number[b:e] for b, e in self.bounds]) if len(at) else self.number[:0]
        held = np.unique(text * max(1, len(self.chunks)) + inside)  # a chunk counts once a text
        text, chunk = np.divmod(held, max(1, len(self.chunks)))
        pair, kind = np.unique(self.links, return_inverse=True)
        size, ends = self.n_links[chunk], np.cumsum(self.n_links)
        shift = (ends - self.n_links)[chunk] - (np.cumsum(size) - size)
        found = np.zeros(len(pair), "i8")
        for b in range(0, len(size), STEP):  # some chunks at a time, but a text's links together below
            e = min(b + STEP, len(size))
            while 0 < e < len(size) and text[e] == text[e - 1]:
                e += 1
            if b and text[b] == text[b - 1]:  # taken with the part before
                b = int(np.searchsorted(text, text[b], "right"))
            if b >= e:
                continue
            n = size[b:e]
            first = int(size[:b].sum())
            link = kind[np.repeat(shift[b:e], n) + first + np.arange(int(n.sum()))]
            own = np.unique(np.repeat(text[b:e], n) * len(pair) + link)
            found += np.bincount(own % len(pair), minlength=len(pair))
        return pair, found


class Aligner:
    """Aligns texts under a byte-level vocabulary (a ``tokenizers`` JSON file, A) and a sentencepiece model (B)."""

    def __init__(self, key: str):
        import os

        import sentencepiece
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path_a, path_b = key.split(_KEY)
        self.whole = Tokenizer.from_file(path_a)
        self.whole.encode_special_tokens = True  # their strings in a text are plain text
        self.letters = byte_letters()
        self.space = self.letters[32]
        own = {c: b for b, c in enumerate(self.letters)}
        vocabulary = self.whole.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(own[c] for c in token) if all(c in own for c in token) else token.encode()
        self.model = self.whole.model
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelled = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(spelled)]
        if any(" " in p.strip("▁").replace("▁", " ") or "\n" in p or p.strip("▁") and p.endswith("▁") for p in spelled):
            raise ValueError("a piece spans the place where texts are cut")
        #: Whether words and the marks behind them are chunks of their own.
        self.cuts_marks = not any(map(_LETTER_AND_MARK.search, spelled))
        self.lone_space = self.pieces.encode("a ")[len(self.pieces.encode("a")):]
        self.size_a, self.size_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.names = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        #: Chunks as they are, and chunks as ``lines`` cuts them: without their space, or with the newline before them.
        self.cache = Chunks(self._aligned, CACHE_CHARS)
        self.plain = Chunks(self._aligned_word, CACHE_CHARS, self._aligned_words)

    def ids_a(self, chunk: str) -> list[int]:
        m = LATIN_WORD.fullmatch(chunk)
        if m is None:
            if chunk[:1] == "\n" and len(chunk) > 1 and not chunk[1].isspace():
                return self.ids_a("\n") + self.ids_a(chunk[1:])
            return self.whole.encode(chunk, add_special_tokens=False).ids
        space, word, marks = m.groups()
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        ids = [t.id for t in self.model.tokenize(self.space + word if space else word)]
        return ids + [t.id for t in self.model.tokenize(marks)] if marks else ids

    def ids_b(self, chunk: str) -> list[int]:
        """The model puts a space before what it is given: here that is the chunk's own, or else it is taken off again."""
        if chunk[:1] == " ":
            return self.pieces.encode(chunk[1:]) if len(chunk) > 1 else self.lone_space
        before = self.pieces.encode("\n")
        return self.pieces.encode("\n" + chunk)[len(before):]

    def _joined(self, a: list[int], b: list[int], chunk: str) -> bytes | None:
        raw = chunk.encode()
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        return aligned(a, b, [self.size_a[i] for i in a], [self.size_b[i] for i in b], self.names)

    def _aligned(self, chunk: str) -> bytes | None:
        """Alignment of one chunk; None if a tokenizer does not spell it out."""
        return self._joined(self.ids_a(chunk), self.ids_b(chunk), chunk)

    def _aligned_word(self, word: str) -> bytes | None:
        """Alignment of a chunk as ``lines`` cuts them."""
        return self._aligned(word if word[:1] == "\n" else word[1:] if word[:1] == _GOES_ON else " " + word)

    def _aligned_words(self, words: list[str]) -> list[bytes | None]:
        """The same for many; the second model takes those that begin with a space all at once."""
        spaced = [w for w in words if w and w[0] not in _APART]
        found = iter(self.pieces.encode(spaced, num_threads=1) if spaced else [])
        tokenize, out = self.model.tokenize, []
        for w in words:
            if not w or w[0] in _APART:
                out.append(self._aligned_word(w))
                continue
            plain = w.isascii() and w.isalpha()
            a = [t.id for t in tokenize(self.space + w)] if plain else self.ids_a(" " + w)
            out.append(self._joined(a, next(found), " " + w))
        return out

    def align(self, text: str) -> list[bytes]:
        """Alignments of the chunks of space and text; none if a tokenizer does not spell out the text."""
        if not text:
            return []
        found = list(map(self.cache.__getitem__, spaced_chunks(" " + text)))
        return [] if None in found else found

    def lines(self, texts: list[str]) -> Lines:
        """Alignments of texts; every chunk that occurs in those without doubled white space is looked up once."""
        easy = [bool(t) and not t[0].isspace() and _GOES_ON not in t and TWO_SPACES.search(t) is None for t in texts]
        plain = [t for t, e in zip(texts, easy) if e]
        if self.cuts_marks:
            plain = [_MARK_AFTER_WORD.sub(f" {_GOES_ON}\\1", t) for t in plain]
        cut = pc.split_pattern(pa.array([t.replace("\n", " \n") for t in plain], pa.large_string()), " ")
        numbered = cut.flatten().dictionary_encode()
        chunks = self.plain.each(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        number = numbered.indices.to_numpy(zero_copy_only=False).astype("i8")
        starts = cut.offsets.to_numpy(zero_copy_only=False)
        unspelled = np.array([c is None for c in chunks], bool)
        bad = np.add.reduceat(unspelled[number], starts[:-1]) > 0 if len(starts) > 1 else np.empty(0, bool)
        ranges = iter(zip(starts[:-1].tolist(), starts[1:].tolist(), bad.tolist()))
        bounds, parts, size = [], [number], len(number)
        chunks = [c or _EMPTY for c in chunks]
        for text, e in zip(texts, easy):
            if e:
                begin, end, is_bad = next(ranges)
                bounds.append((begin, begin if is_bad else end))
            else:
                own = self.align(text)
                parts.append(np.arange(len(chunks), len(chunks) + len(own)))
                chunks += own
                bounds.append((size, size + len(own)))
                size += len(own)
        return Lines(chunks, np.concatenate(parts), bounds)


def _documents(docs: DataFrame, blocks: int) -> DataFrame:
    text = text_of()
    block = F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(blocks)).cast("int")
    return docs.select("doc_id", text.alias("text"), block.alias("block")).repartition(blocks, "block")


def _block_pairs(docs: DataFrame, key: str) -> DataFrame:
    """(block, pair, n): documents of the block that link the pair."""

    def run(part: pa.Table) -> pa.Table:
        pair, n = encoder(Aligner, key).lines(part.column("text").to_pylist()).pairs()
        block = pa.array(np.full(len(pair), part.column("block")[0].as_py(), "i4"))
        return pa.table([block, pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["block", "pair", "n"])

    return docs.groupBy("block").applyInArrow(run, "block int, pair long, n long")


def _hashed(pairs: DataFrame) -> DataFrame:
    """(shard, hash, keys) of the distinct (shard, pair): the perfect hash of every shard and its pairs by number."""

    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("pair").to_numpy().astype("u8")
        made = MinimalHash.of(keys)
        by_number = np.empty(len(keys), "<u8")
        by_number[made.numbers(keys)] = keys
        return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "hash": pa.array([made.to_bytes()], pa.binary()),
                         "keys": pa.array([by_number.tobytes()], pa.binary())})

    return pairs.groupBy("shard").applyInArrow(build, "shard int, hash binary, keys binary")


def _for_leaves(hashes: DataFrame, leaves: int) -> DataFrame:
    return hashes.withColumn("leaf", F.explode(F.sequence(F.lit(0), F.lit(leaves - 1))))


def _summed(held: DataFrame, hashes: DataFrame, leaves: int) -> DataFrame:
    """(shard, counts): for every shard the dense vector of its counts, added up a tree of vectors."""

    def add(rows: pa.Table, index: pa.Table) -> pa.Table:
        if not rows.num_rows or not index.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("shard", pa.int32()), ("leaf", pa.int32()), ("counts", pa.binary()))})
        found = MinimalHash.from_bytes(index.column("hash")[0].as_py())
        counts = np.zeros(found.size, "<i8")
        np.add.at(counts, found.numbers(rows.column("pair").to_numpy()), rows.column("n").to_numpy())
        return pa.table({"shard": index.column("shard"), "leaf": index.column("leaf"), "counts": pa.array([counts.tobytes()], pa.binary())})

    def merge(rows: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x.as_py(), "<i8") for x in rows.column("counts"))
        return pa.table({"shard": rows.column("shard").slice(0, 1), "leaf": rows.column("leaf").slice(0, 1),
                         "counts": pa.array([np.asarray(counts, "<i8").tobytes()], pa.binary())})

    schema = "shard int, leaf int, counts binary"
    spread = _for_leaves(hashes.select("shard", "hash"), leaves)
    vectors = held.groupBy("shard", "leaf").cogroup(spread.groupBy("shard", "leaf")).applyInArrow(add, schema)
    while leaves > 1:
        leaves = -(-leaves // FAN)
        vectors = vectors.withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("int")).groupBy("shard", "leaf").applyInArrow(merge, schema)
    return vectors.select("shard", "counts")


def _best(index: DataFrame, ids: int) -> np.ndarray:
    """Highest count of every id of the first vocabulary: as many numbers as it has ids reach the driver."""

    def highest(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, c = np.frombuffer(keys, "<u8") >> np.uint64(32), np.frombuffer(counts, "<i8")
                best = np.zeros(ids, "i8")
                np.maximum.at(best, a.astype("i8"), c)
                at = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(best[at], pa.int64())], ["a", "c"])

    out = np.zeros(ids, "i8")
    for a, c in index.select("keys", "counts").mapInArrow(highest, "a long, c long").groupBy("a").agg(F.max("c")).collect():
        out[a] = c
    return out


def _asked(held: DataFrame, index: DataFrame, leaves: int) -> DataFrame:
    """(block, pairs, counts) as binary vectors: the corpus-wide counts of the pairs a block holds."""
    names = ["block", "pairs", "counts"]

    def look_up(rows: pa.Table, own: pa.Table) -> pa.Table:
        blocks, pairs, counts = [], [], []
        if rows.num_rows:
            found = MinimalHash.from_bytes(own.column("hash")[0].as_py())
            keys, dense = np.frombuffer(own.column("keys")[0].as_py(), "<u8"), np.frombuffer(own.column("counts")[0].as_py(), "<i8")
            block, pair = rows.column("block").to_numpy(), rows.column("pair").to_numpy()
            order = np.argsort(block, kind="stable")
            block, pair = block[order], pair[order]
            at = found.numbers(pair)
            if not (keys[at] == pair.astype("u8")).all():
                raise ValueError("a pair is not among those that were hashed")
            edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            for b, e in zip(edge, [*edge[1:], len(block)]):
                blocks.append(int(block[b]))
                pairs.append(pair[b:e].astype("<i8").tobytes())
                counts.append(dense[at[b:e]].tobytes())
        return pa.table([pa.array(blocks, pa.int32()), pa.array(pairs, pa.binary()), pa.array(counts, pa.binary())], names)

    spread = _for_leaves(index, leaves)
    return held.groupBy("shard", "leaf").cogroup(spread.groupBy("shard", "leaf")).applyInArrow(look_up, "block int, pairs binary, counts binary")


def pair_index(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows (block, pair, n, shard, leaf), the index (shard, hash, keys, counts) and the number of leaves."""
    held, seen = stored_with(_block_pairs(docs, key), "alignment-pairs", distinct=F.approx_count_distinct("pair"))
    shards = max(1, -(-seen["distinct"] // SHARD_PAIRS))
    leaves = max(1, -(-seen["rows"] // (shards * LEAF_ROWS)))
    held = held.withColumn("shard", F.pmod(F.xxhash64("pair"), F.lit(shards)).cast("int")).withColumn(
        "leaf", F.pmod("block", F.lit(leaves)).cast("int"))
    hashes = stored(_hashed(held.select("shard", "pair").distinct()), "alignment-hashes")
    index = stored(hashes.join(_summed(held, hashes, leaves), "shard"), "alignment-counts")
    return held, index, leaves


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, b, n_docs): every linked pair of ids and the number of documents that link it."""

    def unpack(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pair = np.frombuffer(keys, "<u8").astype("i8")
                yield pa.RecordBatch.from_arrays([pa.array(pair >> 32), pa.array(pair & 0xFFFFFFFF), pa.array(np.frombuffer(counts, "<i8"))], ["a", "b", "n_docs"])

    small_batches(docs.sparkSession)
    return pair_index(_in_blocks(docs), path_a + _KEY + path_b)[1].select("keys", "counts").mapInArrow(unpack, "a long, b long, n_docs long")


def _in_blocks(docs: DataFrame) -> DataFrame:
    size: Column = F.sum(F.octet_length("text"))
    n_bytes = docs.agg(size).first()[0] or 0
    return _documents(docs, max(1, -(-n_bytes // BLOCK_BYTES)))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    small_batches(docs.sparkSession)
    key = path_a + _KEY + path_b
    ids = len(Aligner(key).bytes_a)
    blocked = _in_blocks(docs)
    held, index, leaves = pair_index(blocked, key)
    best_of = _best(index, ids)
    counts = _asked(held, index, leaves)

    def judge(part: pa.Table, asked: pa.Table) -> pa.Table:
        aligner = encoder(Aligner, key)
        pair = np.frombuffer(b"".join(asked.column("pairs").to_pylist()), "<i8")
        count = np.frombuffer(b"".join(asked.column("counts").to_pylist()), "<i8")
        order = np.argsort(pair, kind="stable")
        pair, count = pair[order], count[order]
        best = count == best_of[pair >> 32]
        lines = aligner.lines(part.column("text").to_pylist())
        at = np.searchsorted(pair, lines.links)
        columns = lines.sums(lines.n_a, lines.n_b, lines.n_groups, lines.n_links, lines.per_link(best[at].astype("i8")), lines.per_link(count[at]))
        groups = [groups_of(c) for c in lines.chunks]
        digests = [hashlib.sha256(b";".join([groups[k] for k in lines.number[b:e].tolist()])).hexdigest() if b < e else ""
                   for b, e in lines.bounds]
        return pa.table([part.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns), pa.array(digests, pa.string())],
                        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocked.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(judge, schema)
