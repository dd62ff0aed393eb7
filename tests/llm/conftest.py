import random

import pytest

SCHEMA = "text string, doc_id long, kept string, node long, digest int, h int, tkey string, n_words long, label string, n_chars long"


def passage(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(1, 9))) for _ in range(words))


def odd_texts() -> dict:
    """Nulls, empty, white space, short, very long, periodic and repeated texts, by distinct id."""
    a, b = passage(1, 300), passage(2, 120)
    words = a.split(" ")
    edited = " ".join(w if k != 150 else "changed" for k, w in enumerate(words))
    return {
        0: a, 1: None, 2: "", 3: " \n\t ", 4: a.replace(" ", "  "), 5: edited, 6: "one two", 7: "one  two\n", 8: b + "\n" + b + "\n" + b,
        9: passage(3, 20_000), 10: "x" * 1000, 11: "ab" * 450, 12: passage(4, 60) + " " + b, 13: b + " " + passage(5, 90),
        14: "A SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nAll rights reserved. CC BY-NC", 15: "##$$ %% && | <> * " * 30,
        16: "the same line\n" * 40, 17: "don't  'll 12 3 x́ ͏日本語 <|endoftext|> .\r\n\x1c\x00", 18: None, -5: a,
    }


@pytest.fixture(scope="session")
def texts():
    return odd_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The odd texts with extra columns whose names the operators use themselves."""
    rows = [(t, i, "k", i, 1, 2, "t", 3, "l", len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def repeated(spark):
    """Null ids and rows that are repeated whole."""
    t = passage(7, 200)
    return spark.createDataFrame([(t, None), (t, None), (t, 3), (t, 3), (passage(8, 50), 4), (None, None), (None, 9)], "text string, doc_id long")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}
