"""Mixing, spelling variants and tokenizer alignment against plain Python."""

import itertools
import random
from fractions import Fraction

import numpy as np
import public_tokenizers as vocab
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlens.llm import alignment, mixing, perfect_hash, queries, spelling
from flowlens.llm.encoding import byte_letters

from . import brute
from .conftest import by_id, passage

BYTES, PIECES = vocab.path("byte_bpe_50k.json"), vocab.path("piece_bpe_32k.model")


# mixing


def shared_out(sizes: dict, weights=(3, 1, 2), share=Fraction(3, 2), most=2) -> dict:
    """Targets by source; the share of full sources goes to the others again and again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        open_ = [s for s in names if s not in full]
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        target = {s: Fraction(most * sizes[s]) for s in full}
        target |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


MIXED = "doc_id long, source string, text string, size int, target string, mix_copy int, row string, own int"


def mixed_docs(spark, rows):
    return spark.createDataFrame([(i, s, t, 1, "x", 2, "r", 3) for i, s, t in rows], MIXED)


def test_targets_and_copies(spark):
    r = random.Random(3)
    rows = [(i, s, "w " * r.choice([0, 1, 5, 40, 300])) for i, s in enumerate(r.choices(["", "é", "a", "z", "B", None, "hot"], [1, 2, 3, 1, 1, 2, 30], k=4000))]
    rows += [(None, "a", None), (None, "a", "x\x0by\x1cz"), (7, "a", None), (7, "a", None), (9, "none", " \n")]
    docs = mixed_docs(spark, rows).repartition(5)
    out = mixing.taken(docs).collect()
    assert len(out) == len(rows)
    sizes = {}
    for i, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall((t or "").encode()))
    target = shared_out(sizes)
    drawn = mixing.drawn(docs).collect()
    got, taken = {}, {}
    for x in drawn:
        assert x.copies in (int(x.rate), int(x.rate) + 1) and x.copies * x.size <= 2 * x.size
        got[x.source] = x.target, x.source_size
        taken[x.source] = taken.get(x.source, 0) + x.copies * x.size
    for s, size in sizes.items():
        assert got[s][1] == size and got[s][0] == pytest.approx(float(target[s]), rel=1e-12)
        most = 4 * sum(len((t or "").split()) ** 2 for _, x, t in rows if x == s) ** 0.5
        assert abs(taken[s] - target[s]) <= most
    assert sorted(map(str, out)) == sorted(map(str, mixing.taken(docs.coalesce(1)).collect()))


def test_mix_repeats_whole_rows(spark):
    rows = [(i, "ab"[i % 3 == 0], f"t{i} " * (i % 7 + 1)) for i in range(300)] + [(None, None, None)]
    docs = mixed_docs(spark, rows)
    copies = {x.doc_id: x.copies for x in mixing.drawn(docs).collect()}
    mixed = mixing.mix(docs)
    assert sorted(mixed.columns) == sorted(docs.columns)
    found = mixed.collect()
    assert {x.doc_id for x in found} == {i for i, n in copies.items() if n}
    for i, group in itertools.groupby(sorted(found, key=lambda x: (x.doc_id, x.mix_copy)), key=lambda x: x.doc_id):
        group = list(group)
        assert [x.mix_copy for x in group] == list(range(1, copies[i] + 1))
        assert {(x.text, x.target, x.row, x.own) for x in group} == {(rows[i][2], "x", "r", 3)}


@pytest.mark.parametrize("texts", [[], [None, ""], ["a b"], ["a b", None]])
def test_mix_of_little(spark, texts):
    docs = mixed_docs(spark, [(i, None if i else "s", t) for i, t in enumerate(texts)])
    total = sum(len((t or "").split()) for t in texts)
    out = mixing.taken(docs).collect()
    assert len(out) == len(texts) and {x.target for x in out if x.source_size} <= {min(1.5, 2.0) * total}


def test_many_sources_keep_their_order(spark):
    names = [f"s{i * 7919 % 5000:05}" for i in range(5000)]
    df = spark.createDataFrame([(s, i % 9) for i, s in enumerate(names)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.rates(df).collect()}
    want = shared_out({s: i % 9 for i, s in enumerate(names)})
    assert got == pytest.approx({s: float(t) for s, t in want.items()}, rel=1e-12)


# spelling


def test_one_edit_words_in_blocks_of_every_size(spark):
    r = random.Random(5)
    words = {}
    while len(words) < 600:
        words["".join(r.choice("ab") for _ in range(r.randint(7, 10)))] = int(10 ** r.uniform(0.4, 5))
        words["".join(r.choice("aé") for _ in range(r.randint(1, 9)))] = int(10 ** r.uniform(0.4, 5))
    df = spark.createDataFrame([(w, n, len(w)) for w, n in words.items()], "word string, n long, len int")
    want = brute.spelling_groups(words)
    for most in (spelling.BLOCK_WORDS, 60, 5):
        got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.grouped(df, most=most).collect()}
        assert got == want


def test_chains_of_forms(spark):
    words = {"aaaaaaaaa"[:9 - k] + "b" * k: 10**k for k in range(8)} | {"zzzzzzz": 3, "zzzzzzy": 30, "zzzzzzx": 30}
    df = spark.createDataFrame([(w, n, len(w)) for w, n in words.items()], "word string, n long, len int")
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.grouped(df).collect()}
    assert got == brute.spelling_groups(words)
    assert got["aaaaaaaaa"][1] == "aabbbbbbb" and got["zzzzzzz"][0] == "zzzzzzx"


def spelled(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_spelling_of_odd_texts(spark):
    r = random.Random(2)
    stems = ["".join(r.choice("abcdefé") for _ in range(r.randint(5, 11))) for _ in range(60)]
    rows = [(None if i % 17 == 0 else i % 150, " ".join(r.choice(stems).title() for _ in range(60)) + "×÷ ß1ÿÿÿÿÿÿÿ-ABCDEFGH") for i in range(400)]
    rows += [(1, None), (2, ""), (None, None), (3, "x" * 500_000), (3, "x" * 500_000), (4, "İstanbulu İstanbulu ſssssssss")]
    docs = spark.createDataFrame([(t, i, "k", 1, 2, "w") for i, t in rows], "text string, doc_id long, key string, n int, len int, word string")
    got = spelled(spelling.variant_groups(docs.repartition(3)).collect())
    assert got == brute.spelling_groups(brute.spelling_words(rows))
    assert spelling.variant_groups(docs.where("false")).count() == 0


def test_spelling_of_the_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    words = brute.spelling_words(rows)
    got = spelled(queries.QUERIES["op13_spelling_groups"](spark, sf_dir).collect())
    assert {w: g[2] for w, g in got.items()} == words
    some = dict(itertools.islice(sorted(words.items()), 0, None, max(1, len(words) // 300)))
    for w in some:
        near = [x for x in words if brute.one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        assert got[w][3] == len(near) and got[w][0] == (best if best and words[best] >= 10 * words[w] else None)


# alignment


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=3000))
def test_perfect_hash(keys):
    array = np.array(sorted(keys), "u8")
    made = perfect_hash.MinimalHash.of(array)
    again = perfect_hash.MinimalHash.from_bytes(made.to_bytes())
    assert sorted(made.numbers(array).tolist()) == list(range(len(keys))) and again.numbers(array).tolist() == made.numbers(array).tolist()
    assert again.size == len(keys)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    own = {c: b for b, c in enumerate(byte_letters())}
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return (lambda t: a.encode(t, add_special_tokens=False).ids, lambda i: bytes(own.get(c, 0) for c in a.id_to_token(i)), b.encode, bytes_b)


def aligned(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


ODD = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n", "\na", "a\nb", "a\n\nb c", "a \n b", "\ta\tb", "a▁b", "x\x00y", "<|endoftext|> <s> <0x0A>",
       "日本語 の 文", "é ﬁ   x", "don't 'll  12 3.5", "\r\n a\r\n", "😀😀 x y", "word,word; (word) &&& ***", "▁", "a b " * 300]


def test_alignment_of_odd_texts(spark, docs, texts, libraries):
    all_texts = {i: t or "" for i, t in texts.items()} | {1000 + k: t for k, t in enumerate(ODD)} | {2000: passage(3, 400) + "\n" + passage(4, 30)}
    rows = [(t, i, 1, 2, "p", "k") for i, t in all_texts.items()] + [(None, 3000, 1, 2, "p", "k")]
    df = spark.createDataFrame(rows, "text string, doc_id long, block int, n int, pair string, key string").repartition(3)
    want = brute.alignments(all_texts | {3000: ""}, *libraries)
    assert aligned(alignment.align_tokenizers(df, BYTES, PIECES)) == want
    pairs = alignment.pair_counts(df, BYTES, PIECES)
    assert pairs.groupBy("a", "b").count().where("count > 1").count() == 0
    assert pairs.agg(F.max("n_docs")).first()[0] > 1


def test_alignment_in_many_blocks_shards_and_leaves(spark, monkeypatch, libraries):
    for name, value in (("BLOCK_BYTES", 2000), ("SHARD_PAIRS", 64), ("LEAF_ROWS", 16), ("FAN", 2), ("STEP", 9)):
        monkeypatch.setattr(alignment, name, value)
    all_texts = {i: passage(i % 25, 30) + f" the {i % 7} end" for i in range(120)}
    df = spark.createDataFrame([(i, t) for i, t in all_texts.items()], "doc_id long, text string")
    assert aligned(alignment.align_tokenizers(df, BYTES, PIECES)) == brute.alignments(all_texts, *libraries)


def test_alignment_of_repeated_and_no_rows(repeated, no_docs):
    rows = alignment.align_tokenizers(repeated, BYTES, PIECES).collect()
    assert len(rows) == 7 and len({r.groups_sha256 for r in rows}) == 3
    assert alignment.align_tokenizers(no_docs, BYTES, PIECES).count() == 0


def test_alignment_of_the_whole_table(spark, sf_dir, libraries):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert aligned(queries.QUERIES["op11_align_tokenizers"](spark, sf_dir)) == brute.alignments(texts, *libraries)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB é,.'s1 \n\t\r  \x1c日▁😀<|>x0"), max_size=40))
def test_chunks_align_as_whole_texts(text):
    own = _aligner()
    found = own.align(text)
    b = own.pieces.encode(text) if text else []
    a = own.whole.encode(" " + text, add_special_tokens=False).ids if text else []
    raw = f" {text}".encode()
    if not text or b"".join(own.bytes_a[i] for i in a) != raw or b"".join(own.bytes_b[i] for i in b) != raw:
        assert not found
    else:
        groups = [g.split("|") for x in found for g in alignment.groups_of(x).decode().split(";")]
        assert [int(x) for g in groups for x in g[0].split(",")] == a and [int(x) for g in groups for x in g[1].split(",")] == b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é,.'s1 \n\t\r  日▁😀"), max_size=20), max_size=6))
def test_many_texts_align_as_each_alone(texts):
    own = _aligner()
    lines = own.lines(texts)
    for text, (b, e) in zip(texts, lines.bounds):
        together = [b";".join(map(alignment.groups_of, x)) for x in ([lines.chunks[k] for k in lines.number[b:e]], own.align(text))]
        assert together[0] == together[1]


def _aligner(made=[]):  # noqa: B006
    if not made:
        made.append(alignment.Aligner(BYTES + "\0" + PIECES))
    return made[0]


def test_repeated_ids_in_the_other_two(spark, repeated):
    rows = mixing.taken(repeated.withColumn("source", F.lit("s"))).collect()
    assert len(rows) == 7 and {x.size for x in rows if x.doc_id == 9} == {0}
    assert by_id(spelling.variant_groups(repeated).withColumnRenamed("word", "doc_id")) is not None
