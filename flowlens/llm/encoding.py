"""Encoders of whole texts that merge every distinct chunk once.

A text is cut only where no pre-token of the vocabulary can span the cut, so the ids of the chunks, joined, are the ids of the
text. Chunks repeat as words do; a cache of bounded size, kept by the Python worker, spares most merges. What a full cache
forgets is merged again, which changes no result.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of the chunks a worker remembers in each of two generations; a chunk of 8 takes about 170 bytes with its ids.
CACHE_CHARS = 2_000_000
#: Longer chunks are rare or never come again (base64, scripts without spaces) and are not remembered.
LONGEST = 64

#: Stands before the first chunk of a text in ``ids_of_spaced``.
_MARK = "\0"
TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
#: Space, letters, and the signs after them, which every pattern here takes as one pre-token.
LATIN_WORD = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


def byte_letters() -> list[str]:
    """One printable character for each byte, as byte-level vocabularies spell them."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def spaced_chunks(text: str) -> list[str]:
    """The text cut before each space that follows a non-space character, and around single newlines."""
    if TWO_SPACES.search(text) is not None:
        return [x for x in _CUT.split(text) if x]
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        if k:
            out.append("\n")
        first, *rest = line.split(" ")
        if first:
            out.append(first)
        out += [" " + x for x in rest]
    return out


class Chunks(dict):
    """Cache from a chunk to what ``encode`` gives for it, as a rule its ids as little-endian unsigned 32-bit integers.

    It has two generations: what was used since the younger one began stays when the older one is dropped.
    """

    def __init__(self, encode, most: int | None = None, encode_all=None):
        super().__init__()
        self.encode, self.older, self.chars, self.most = encode, {}, 0, most or CACHE_CHARS
        self.encode_all = encode_all or (lambda chunks: list(map(encode, chunks)))

    def _turn(self):
        self.older, self.chars = dict(self), 0
        self.clear()

    def __missing__(self, chunk: str):
        found = self.older.get(chunk)
        if found is None:
            found = self.encode(chunk)
        if len(chunk) <= LONGEST:
            if self.chars > self.most:
                self._turn()
            self[chunk] = found
            self.chars += len(chunk) or 1
        return found

    def each(self, chunks: list[str]) -> list:
        """What belongs to every one of some different chunks."""
        if self.chars > self.most:
            self._turn()
        out = list(map(self.get, chunks))
        at = [i for i, x in enumerate(out) if x is None]
        found = list(map(self.older.get, [chunks[i] for i in at]))
        new = iter(self.encode_all([chunks[i] for i, x in zip(at, found) if x is None]))
        for i, x in zip(at, found):
            chunk = chunks[i]
            out[i] = x = next(new) if x is None else x
            if len(chunk) <= LONGEST:
                self[chunk] = x
                self.chars += len(chunk) or 1
        return out

    def joined(self, chunks: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, chunks))


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def ids_of_chunks(texts: list[str], cache: Chunks) -> list[np.ndarray]:
    """Ids of texts whose chunks lie between single spaces; every chunk that occurs in them is looked up once.

    The texts are cut and their chunks numbered by Arrow; the ids of all are then gathered at once.
    """
    cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    numbered = cut.flatten().dictionary_encode()
    each = cache.each(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
    sizes = np.fromiter(map(len, each), "i8", len(each)) // 4
    at = numbered.indices.to_numpy(zero_copy_only=False)
    size = sizes[at]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    # a chunk's ids lie at its place in ``each``; shifted by where they go, they follow from the running number
    shift = (np.cumsum(sizes) - sizes)[at] - (ends - size)
    ids = np.frombuffer(b"".join(each), "<u4")[np.repeat(shift, size) + np.arange(total)]
    bounds = np.r_[0, ends][cut.offsets.to_numpy(zero_copy_only=False)].tolist()
    return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


def ids_of_spaced(texts: list[str], marked: Chunks, encode) -> list[np.ndarray]:
    """Ids of texts with ``spaced_chunks``; ``marked`` takes chunks as ``unmarked`` reads them.

    Texts with doubled white space, or with the mark itself, are encoded one by one.
    """
    easy = [TWO_SPACES.search(t) is None and _MARK not in t for t in texts]
    found = iter(ids_of_chunks([_MARK + t.replace("\n", " \n") for t, e in zip(texts, easy) if e], marked))
    return [next(found) if e else np.frombuffer(encode(t), "<u4") for t, e in zip(texts, easy)]


def unmarked(chunk: str) -> tuple[str, str]:
    """Newline before the chunk, if any, and the chunk with its space: marked chunks have none, nor has what follows a newline."""
    if chunk[:1] == "\n":
        return "\n", chunk[1:]
    return "", chunk[1:] if chunk[:1] == _MARK else " " + chunk


class WordEncoder:
    """Vocabulary with word ends, lower case, white space dropped (a ``tokenizers`` JSON file).

    Plain Latin words go to the library's merge model at once, everything else through its whole chain.
    """

    def __init__(self, path: str):
        self.whole, self.model = _load(path)
        self.letters = byte_letters()
        self.cache, self.marks = Chunks(self._ids), Chunks(self._merged)

    def _ids(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._merged(chunk.lower())
        m = LATIN_WORD.fullmatch(chunk)
        if m is None:
            return packed(self.whole.encode(chunk, add_special_tokens=False).ids)
        _, word, marks = m.groups()
        ids = marks and self.cache.get(word) or self._merged(word.lower())
        return ids + self.marks[marks] if marks else ids

    def _merged(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else _spelled(piece, self.letters)
        return packed([t.id for t in self.model.tokenize(spelled)])

    def encode(self, text: str) -> bytes:
        return self.cache.joined(text.replace("\n", " ").split(" "))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        return ids_of_chunks([t.replace("\n", " ") for t in texts], self.cache)


def _spelled(piece: str, letters: list[str]) -> str:
    """Piece without white space, one character a byte."""
    return piece if piece.isascii() else "".join([letters[b] for b in piece.encode()])


class ByteEncoder:
    """Byte-level vocabulary (a ``tokenizers`` JSON file)."""

    def __init__(self, path: str):
        self.whole, self.model = _load(path)
        self.letters = byte_letters()
        self.space = self.letters[32]
        #: Chunks as they are, and chunks without the space they begin with.
        self.cache, self.spaced = Chunks(self._ids), Chunks(lambda rest: self._ids(" " + rest))
        self.marked, self.marks = Chunks(self._marked_ids), Chunks(self._merged)

    def _marked_ids(self, chunk: str) -> bytes:
        if chunk.isalpha() and (chunk.isascii() or max(chunk) <= "ÿ"):
            return packed([t.id for t in self.model.tokenize(self.space + _spelled(chunk, self.letters))])
        line, rest = unmarked(chunk)
        ids = self.cache[line] if line else b""
        return ids + self._ids(rest) if rest else ids

    def _ids(self, chunk: str) -> bytes:
        m = LATIN_WORD.fullmatch(chunk)
        if m is None:
            return packed(self.whole.encode(chunk, add_special_tokens=False).ids)
        space, word, marks = m.groups()
        ids = marks and space and self.marked.get(word)
        if not ids:
            ids = self._merged(self.space + _spelled(word, self.letters) if space else _spelled(word, self.letters))
        return ids + self.marks[marks] if marks else ids

    def _merged(self, spelled: str) -> bytes:
        return packed([t.id for t in self.model.tokenize(spelled)])

    def encode(self, text: str) -> bytes:
        return encode_spaced(text, self.cache, self.spaced)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        return ids_of_spaced(texts, self.marked, self.encode)


def encode_spaced(text: str, cache: Chunks, spaced: Chunks) -> bytes:
    """Ids of a text from its ``spaced_chunks``; ``spaced`` knows them without the space they begin with."""
    if TWO_SPACES.search(text) is not None:
        return cache.joined(spaced_chunks(text))
    lines = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        lines.append((cache[first] if first else b"") + spaced.joined(rest))
    return cache["\n"].join(lines) if len(lines) > 1 else lines[0]


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    return whole, whole.model


_ENCODERS: dict[tuple[type, str], object] = {}


def encoder(kind: type, path: str):
    """The worker's encoder of this kind and file; loaded once for all tasks of a worker."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
