"""Packing of documents into training sequences by order-preserving dynamic programming.

Documents lie in order of ``doc_id``, end to end. The token line is cut into windows of at most ``length`` tokens; a cut costs
the padding of its window plus a penalty: none at the end of a document, a little at the end of a sentence, more inside one.
With f(j) the least cost up to cut j, f(j) = min f(i) + length - (b_j - b_i) + penalty(j) over cuts i at most ``length``
before j: a minimum of f(i) + b_i over a sliding window, kept by a monotone queue, so the work is linear in the cuts.

The line is handled in runs of a bounded number of tokens; the last window of a run opens the next one. Each range of
documents (one task) ends in a rest, which is cut at powers of two, the lengths that need no padding.

Defined results: null and empty texts give the end id only; a null ``doc_id`` sorts first; repeated rows are documents of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import in_id_order, slices, small_batches
from flowlens.llm.encoding import ByteEncoder, encoder

#: Cost of a cut, in padding tokens: at the end of a sentence, and inside one.
SENTENCE_CUT, HARD_CUT = 4, 24
#: Where no document or sentence ends for this long, a cut may fall inside the sentence.
MOST_UNCUT = 32
#: Tokens of one run of the recursion.
RUN_TOKENS = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def best_cuts(cuts: list[int], penalties: list[int], length: int) -> list[int]:
    """Window ends chosen among ``cuts`` (ascending, positive, gaps of at most ``length``); the last one is always chosen.

    Of equal costs the earlier predecessor, the longer window, wins.
    """
    positions = [0, *cuts]
    cost, back = [0] * len(positions), [0] * len(positions)
    queue = deque([0])  # indexes with ascending cost + position
    keys = [0] * len(positions)
    for j in range(1, len(positions)):
        p = positions[j]
        while p - positions[queue[0]] > length:
            queue.popleft()
        i = queue[0]
        back[j], cost[j] = i, keys[i] + length - p + penalties[j - 1]
        k = keys[j] = cost[j] + p
        while queue and keys[queue[-1]] > k:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(positions) - 1
    while j:
        chosen.append(positions[j])
        j = back[j]
    return chosen[::-1]


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, most_uncut: int) -> tuple[list[int], list[int]]:
    """Positions where a window may end, with their penalties; the end of the run is one of them, free of charge."""
    n = len(ids)
    penalty = np.full(n + 1, -1, "i4")
    penalty[1:][ends_sentence[ids]] = SENTENCE_CUT
    penalty[doc_ends] = 0
    penalty[n], penalty[0] = 0, -1
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at, prepend=0)
    more = (gaps - 1) // most_uncut  # cuts inside each gap, most_uncut apart from its begin
    if more.any():
        begin = np.repeat(at - gaps, more)
        number = np.arange(len(begin)) - np.repeat(np.cumsum(more) - more, more) + 1
        penalty[begin + number * most_uncut] = HARD_CUT
        at = np.flatnonzero(penalty >= 0)
    return at.tolist(), penalty[at].tolist()


def powers(n: int) -> list[int]:
    """Powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Takes the documents of one task in order and gives the pieces of finished sequences."""

    def __init__(self, length: int, first_sequence: int, ends_sentence: np.ndarray):
        self.length, self.sequence, self.ends = length, first_sequence, ends_sentence
        self.docs: list[list] = []  # doc_id, ids not yet packed, tokens already packed, tokens in all
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append([doc_id, ids, 0, len(ids)])
        self.waiting += len(ids)
        out: list[tuple] = []
        while self.waiting >= RUN_TOKENS:
            before = self.waiting
            out += self._run(last=False)
            if self.waiting == before:
                break
        return out

    def finish(self) -> list[tuple]:
        return self._run(last=True) if self.waiting else []

    def _run(self, last: bool) -> list[tuple]:
        most, parts, size = self.waiting if last else RUN_TOKENS, [], 0
        for _, ids, _, _ in self.docs:
            parts.append(ids[: most - size])
            size += len(ids)
            if size >= most:
                break
        line = np.concatenate(parts)
        ends = np.cumsum([len(d[1]) for d in self.docs[: len(parts)]])
        cuts, penalties = candidate_cuts(line, ends[ends <= len(line)], self.ends, min(MOST_UNCUT, self.length))
        windows = best_cuts(cuts, penalties, self.length)
        tail = windows.pop() - (windows[-1] if windows else 0)
        if last:
            start = windows[-1] if windows else 0
            for part in [tail] if tail == self.length else powers(tail):
                start += part
                windows.append(start)
        elif not windows:
            windows = [tail]
        out, begin = [], 0
        for end in windows:
            out += self._sequence(end - begin)
            begin = end
        return out

    def _sequence(self, n: int) -> list[tuple]:
        out, offset = [], 0
        taken = 0
        for doc in self.docs:
            doc_id, ids, start, total = doc
            part = ids[: n - offset]
            out.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), total, self.sequence, offset))
            offset += len(part)
            if len(part) < len(ids):
                doc[1], doc[2] = ids[len(part) :], start + len(part)
            else:
                taken += 1
            if offset == n:
                break
        del self.docs[:taken]
        self.waiting -= n
        self.sequence += 1
        return out


class SentenceEnds:
    """For every id of the vocabulary, whether its text ends a sentence or a line."""

    def __init__(self, path: str):
        vocabulary = encoder(ByteEncoder, path).whole.get_vocab()
        self.ends = np.zeros(len(vocabulary), bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith((".", "!", "?", "Ċ"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """One row per piece of a document in a sequence; see the module for the method and the defined results.

    ``sequence_id`` counts up inside a range of documents and is unique over all of them.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4")
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        coder = encoder(ByteEncoder, tokenizer)
        packer = Packer(length, TaskContext.get().partitionId() << 36, encoder(SentenceEnds, tokenizer).ends)

        def rows(pieces):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces)], names)

        pieces: list[tuple] = []
        for part, texts in slices(batches):
            for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode_all(texts)):
                pieces += packer.add(doc_id, np.concatenate([ids, end]))
            if pieces:
                yield rows(pieces)
                pieces = []
        pieces = packer.finish()
        if pieces:
            yield rows(pieces)

    return in_id_order(docs).mapInArrow(run, SCHEMA)
