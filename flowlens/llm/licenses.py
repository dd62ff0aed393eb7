"""Licence scan: notice phrases and identifier tags by Aho-Corasick, licence expressions by a shunting-yard parser.

A text is lower-cased (A-Z), every run of ASCII characters other than letters and digits becomes one space, and one pass of
the automaton finds all phrases and tags at word boundaries. Where it finds the tag ``SPDX-License-Identifier``, the
expression after its last word is parsed (``with`` binds before ``and``, ``and`` before ``or``) and evaluated. Whole licence
texts are recognised by sentences of their own, others by title or usual notice.

Score: how restrictive the terms are, 0 (none found, or free) to 1 (all rights reserved); of an expression, ``or`` takes the
smaller side, ``and`` the larger, ``with`` (an exception) four fifths of its licence; of a text, the largest.

Defined results: null and empty texts have no words and score 0; an expression is read as far as it is well formed, and an
unbalanced or empty one gives the label ``invalid-expression``; repeated rows give a row each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import slices, small_batches, text_of

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Phrases of our own: words, label, restrictiveness.
NOTICES = (
    ("apache license version 2 0", "apache-2.0", 0.2), ("mit license", "mit", 0.1),
    ("permission is hereby granted free of charge", "mit", 0.1),
    ("redistribution and use in source and binary forms", "bsd", 0.1), ("mozilla public license", "mpl", 0.4),
    ("lesser general public license", "lgpl", 0.5), ("affero general public license", "agpl", 0.8),
    ("cc by sa", "cc-by-sa", 0.5), ("cc by nc", "cc-by-nc", 0.8), ("cc by nd", "cc-by-nd", 0.8), ("cc0", "cc0", 0.0),
    ("public domain", "public-domain", 0.0), ("eclipse public license", "epl", 0.4), ("isc license", "isc", 0.1),
    # sentences of whole licence texts
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc", 0.1),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd-3-clause", 0.1),
    ("licensed under the apache license", "apache", 0.2),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2.0", 0.4),
    ("this is free and unencumbered software released into the public domain", "unlicense", 0.0),
    ("altered source versions must be plainly marked as such", "zlib", 0.1),
    ("you should have received a copy of the gnu general public license", "gpl", 0.6),
    ("you should have received a copy of the gnu lesser general public license", "lgpl", 0.5),
    ("you should have received a copy of the gnu affero general public license", "agpl", 0.8),
    # titles and names
    ("boost software license", "bsl", 0.1), ("zlib license", "zlib", 0.1), ("artistic license", "artistic", 0.3),
    ("bsd license", "bsd", 0.1), ("python software foundation license", "psf", 0.1), ("academic free license", "afl", 0.2),
    ("gnu free documentation license", "gfdl", 0.6), ("sil open font license", "ofl", 0.2),
    ("european union public licence", "eupl", 0.6), ("common development and distribution license", "cddl", 0.4),
    ("microsoft public license", "ms-pl", 0.3), ("server side public license", "sspl", 0.9),
    ("business source license", "busl", 0.9), ("elastic license", "elastic", 0.9), ("open database license", "odbl", 0.5),
    ("creative commons attribution", "cc-by", 0.2), ("creative commons attribution sharealike", "cc-by-sa", 0.5),
    ("creative commons attribution share alike", "cc-by-sa", 0.5), ("creative commons attribution noncommercial", "cc-by-nc", 0.8),
    ("creative commons attribution non commercial", "cc-by-nc", 0.8), ("no rights reserved", "cc0", 0.0),
    ("proprietary and confidential", "proprietary", 1.0),
)
BASE_SCORES = {"cc-by": 0.2, "gpl": 0.6, "reserved": 1.0}
#: Restrictiveness of expression identifiers by their beginning; others score UNKNOWN.
FAMILIES = (("agpl", 0.8), ("lgpl", 0.5), ("gpl", 0.6), ("mit", 0.1), ("bsd", 0.1), ("isc", 0.1), ("apache", 0.2), ("mpl", 0.4),
            ("epl", 0.4), ("cc0", 0.0), ("unlicense", 0.0), ("cc-by-nc", 0.8), ("cc-by-nd", 0.8), ("cc-by-sa", 0.5), ("cc-by", 0.2))
UNKNOWN = 0.5
TAG = "spdx license identifier"
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACED = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in _LOWER)
_WORD = re.compile(rb"[^ ]+")
_COLON = re.compile(r"\s*:?\s*", re.ASCII)
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}


def identifier_score(name: str) -> float:
    return next((s for start, s in FAMILIES if name.startswith(start)), UNKNOWN)


def evaluate(text: str, at: int = 0) -> tuple[set[str], float] | None:
    """Identifiers and score of the licence expression that begins at ``at`` (lower case); None if there is none.

    Reading stops before the first token that cannot continue an expression.
    """
    values: list[float] = []
    operators: list[str] = []
    names: set[str] = set()
    want_operand, open_brackets = True, 0

    def reduce() -> None:
        op, b, a = operators.pop(), values.pop(), values.pop()
        values.append(min(a, b) if op == "or" else max(a, b) if op == "and" else 0.8 * a)

    while m := _TOKEN.match(text, at):
        token = m[1]
        if want_operand:
            if token == "(":
                operators.append(token)
                open_brackets += 1
            elif token == ")" or token in _BINDS:
                return None
            else:
                token = token.rstrip(".")
                names.add(token)
                values.append(identifier_score(token))
                want_operand = False
        elif token in _BINDS:
            while operators and operators[-1] != "(" and _BINDS[operators[-1]] >= _BINDS[token]:
                reduce()
            operators.append(token)
            want_operand = True
        elif token == ")" and open_brackets:
            while operators[-1] != "(":
                reduce()
            operators.pop()
            open_brackets -= 1
        else:
            break
        at = m.end()
    if want_operand or open_brackets:
        return None
    while operators:
        reduce()
    return names, values[0]


class Scanner:
    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        terms: dict[str, tuple] = {TAG: (None, 0.0, False)}
        terms |= {words: (label, score, False) for words, label, score in NOTICES}
        terms |= {words: (label, BASE_SCORES[label], True) for words, label in BASE.items()}
        for words, (label, score, base) in terms.items():
            self.automaton.add_word(f" {words} ", (len(words) + 2, label, score, base))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple:
        raw = text.encode()
        spaced = raw.translate(_SPACED)
        words = spaced.split()
        line = f" {b' '.join(words).decode()} "
        places, tags, base, labels, score = [], [], set(), set(), 0.0
        for end, (size, label, value, is_base) in self.automaton.iter(line):
            if label is None:
                tags.append(end - size + 1)
                continue
            labels.add(label)
            score = max(score, value)
            if is_base:
                base.add(label)
                places.append(end - size + 1)
        if tags:
            # one character a byte, so that the ends of words are places of the text
            lower, ends = raw.translate(_LOWER).decode("latin-1"), [m.end() for m in _WORD.finditer(spaced)]
            number = before = 0
            for place in tags:
                number, before = number + line.count(" ", before, place), place
                found = evaluate(lower, _COLON.match(lower, ends[number + TAG.count(" ")]).end())
                labels |= found[0] if found else {"invalid-expression"}
                score = max(score, found[1] if found else UNKNOWN)
        word = lambda place: line.count(" ", 0, place)
        return (len(words), len(places), word(min(places)) if places else None, word(max(places)) if places else None,
                ",".join(sorted(base)), ",".join(sorted(labels)), score)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document; words are counted from 0, labels are distinct, sorted and joined by commas."""
    small_batches(docs.sparkSession)
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        scanner = Scanner()
        for rows, texts in slices(batches):
            found = zip(*(scanner.scan(t) for t in texts))
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))], names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, SCHEMA)
