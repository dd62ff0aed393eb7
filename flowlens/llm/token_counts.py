"""Token counts of the sections of documents, from one encoding of each whole text.

A section is a paragraph: the lines between blank lines, or up to SECTION_LINES lines in a row, so that texts without blank
lines have sections too. The whole text is encoded once; each token's character span comes from the encoder and is joined with
the section spans, both ascending, by binary search.

Rule for a token that crosses a boundary: it counts whole for the section that holds most of its characters; of equal shares
the earlier section gets it; a token whose characters lie in no section (white space between two) counts for the section
before it, or for the first one. So the counts of the sections add up to the tokens of the document.

Defined results: null and empty texts, and texts of white space only, are one section, the whole text; repeated rows give a row
per section each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import slices, small_batches, text_of
from flowlens.llm.encoding import LATIN_WORD, ByteEncoder, Chunks, encoder, packed, spaced_chunks

SECTION_LINES = 8
_LINE = re.compile(r"[^\n]*\n?")


def sections_of(text: str) -> list[tuple[int, int]]:
    """Character spans [start, end) of the sections, ascending."""
    spans, lines = [], 0
    for m in _LINE.finditer(text):
        if not m[0].strip():
            lines = 0
        elif lines and lines < SECTION_LINES:
            spans[-1] = (spans[-1][0], m.end())
            lines += 1
        else:
            spans.append((m.start(), m.end()))
            lines = 1
    return spans or [(0, len(text))]


class SpanEncoder(ByteEncoder):
    """Also remembers, for every chunk, the character spans of its tokens."""

    def __init__(self, path: str):
        super().__init__(path)
        self.cache = Chunks(self._spans)

    def _spans(self, chunk: str) -> bytes:
        m = LATIN_WORD.fullmatch(chunk)
        if m is None or not chunk.isascii():
            return packed([x for span in self.whole.encode(chunk, add_special_tokens=False).offsets for x in span])
        # plain words by the merge model, whose offsets count bytes: two for the letter that spells a space
        space, word, marks = m.groups()
        out = [x for t in self.model.tokenize(self.space + word if space else word) for x in t.offsets]
        if space:
            out = [max(x - 1, 0) for x in out]
        if marks:
            out += [x + len(space) + len(word) for t in self.model.tokenize(marks) for x in t.offsets]
        return packed(out)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and character after the last, of every token of the text."""
        chunks = spaced_chunks(text)
        flat = np.frombuffer(self.cache.joined(chunks), "<u4").astype("i8").reshape(-1, 2)
        begin = np.cumsum([0, *map(len, chunks)])[:-1]
        flat = flat + np.repeat(begin, [len(self.cache[c]) // 8 for c in chunks])[:, None]
        return flat[:, 0], flat[:, 1]


def attribute(begin: np.ndarray, end: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens per section.

    A token overlaps sections ``first`` to ``last``; inner ones are held whole, so the largest share is found by comparing the
    overlaps section by section, which for all tokens together is one pass per number of sections crossed.
    """
    starts, stops = (np.array(x, "i8") for x in zip(*spans))
    first = np.searchsorted(stops, begin, "right")
    last = np.searchsorted(starts, end, "left") - 1
    owner = np.clip(first - 1, 0, len(spans) - 1)
    best = np.zeros(len(begin), "i8")
    step, rows = 0, np.flatnonzero(last >= first)
    while len(rows):
        s = first[rows] + step
        share = np.minimum(end[rows], stops[s]) - np.maximum(begin[rows], starts[s])
        better = share > best[rows]
        owner[rows[better]], best[rows[better]] = s[better], share[better]
        step += 1
        rows = rows[last[rows] >= first[rows] + step]
    # white space outside every section counts as crossing as well: the token does not lie in its section whole
    crossing = (begin < starts[owner]) | (end > stops[owner])
    return np.bincount(owner, minlength=len(spans)), np.bincount(owner[crossing], minlength=len(spans))


def section_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per section: doc_id, section (from 0), start, length (characters), n_tokens, n_crossing, doc_tokens."""
    small_batches(docs.sparkSession)

    def run(batches):
        coder = encoder(SpanEncoder, tokenizer)
        for rows, texts in slices(batches):
            ids, columns = [], [array("q") for _ in range(6)]
            for doc_id, text in zip(rows.column(0).to_pylist(), texts):
                spans = sections_of(text)
                begin, end = coder.spans(text)
                n, crossing = attribute(begin, end, spans)
                ids += [doc_id] * len(spans)
                for column, values in zip(columns, (range(len(spans)), (a for a, _ in spans), (b - a for a, b in spans),
                                                    n.tolist(), crossing.tolist(), [len(begin)] * len(spans))):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(np.frombuffer(c, "i8") if len(c) else [], pa.int64()) for c in columns)],
                ["doc_id", "section", "start", "length", "n_tokens", "n_crossing", "doc_tokens"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, "doc_id long, section long, start long, length long, n_tokens long, n_crossing long, doc_tokens long")
