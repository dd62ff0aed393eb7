"""Token files, packing, section counts and piece-model BPE against the libraries on whole texts."""

import base64
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowlens.llm import encoding, packing, piece_bpe, queries, token_counts, token_files
from flowlens.llm.encoding import ByteEncoder, WordEncoder, encoder, spaced_chunks

from .conftest import by_id

WORDS, BYTES, RANKS = (vocab.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
TEXT = st.text(st.sampled_from("aB é,.'sl12 \n\t\r  \x1ć日Σς😀İ"), max_size=40)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_chunked_encoders_equal_the_libraries(text):
    words, letters = _encoders()
    assert np.frombuffer(words.encode(text), "<u4").tolist() == words.whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(letters.encode(text), "<u4").tolist() == letters.whole.encode(text, add_special_tokens=False).ids
    assert "".join(spaced_chunks(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.one_of(TEXT, st.lists(st.text("abcXYZ", min_size=1, max_size=9)).map(" ".join).map(lambda t: t + ".")))
def test_spans_equal_the_library(text):
    coder = encoder(token_counts.SpanEncoder, BYTES)
    begin, end = coder.spans(text)
    assert list(zip(begin.tolist(), end.tolist())) == coder.whole.encode(text, add_special_tokens=False).offsets


def _encoders(made=[]):  # noqa: B006
    if not made:
        made += [WordEncoder(WORDS), ByteEncoder(BYTES)]
    return made


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_packed_ids_come_back(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 640).astype("<u4")
    assert (token_files.unpack(token_files.pack(ids, bits), bits) == ids).all()
    assert token_files.bits_for(1 << bits) == bits


def test_random_access_reads_any_range(tmp_path):
    ids = np.random.default_rng(0).integers(0, 49_408, 30_000).astype("<u4")
    with open(tmp_path / "x.bin", "wb") as out:
        writer = token_files.TokenFileWriter(out, 16)
        for k, part in enumerate(np.split(ids, [10, 10, 20_000])):
            writer.add(k or None, part)
        writer.close()
    file = token_files.TokenFile(str(tmp_path / "x.bin"))
    for start, n in ((0, 1), (4095, 2), (8192, 4096), (29_999, 1), (5, 0)):
        assert (file.ids(start, n) == ids[start : start + n]).all()
    assert [len(file.document(i)) for i in range(4)] == [10, 0, 19_990, 10_000] and file.no_id.tolist() == [1, 0, 0, 0]
    with pytest.raises(ValueError):
        token_files.TokenFileWriter(open(tmp_path / "y.bin", "wb"), 3).add(1, np.array([8], "<u4"))


def check_token_files(rows, texts, library):
    start = 0
    for i in sorted(texts):
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert tuple(rows[i]) == (i, start, len(ids), crc(ids))
        start += len(ids)


def test_token_files(docs, texts, word_library):
    check_token_files(by_id(token_files.token_files(docs, WORDS)), texts, word_library)


def test_token_files_of_the_whole_table(spark, sf_dir, word_library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_token_files(by_id(queries.QUERIES["op1_token_files"](spark, sf_dir)), texts, word_library)


def test_token_operators_on_no_rows_and_repeated_rows(no_docs, repeated):
    assert token_files.token_files(no_docs, WORDS).count() == 0 and packing.pack_documents(no_docs, BYTES).count() == 0
    assert token_counts.section_tokens(no_docs, BYTES).count() == 0
    assert piece_bpe.encode_and_decode(no_docs, RANKS, vocab.PATTERN).count() == 0
    rows = token_files.token_files(repeated, WORDS).collect()
    assert len(rows) == 7 and sorted(r.start for r in rows)[0] == 0 and sum(r.doc_id is None for r in rows) == 3
    assert packing.pack_documents(repeated, BYTES).select("doc_id").distinct().count() == 4
    assert token_counts.section_tokens(repeated, BYTES).count() == 7
    assert piece_bpe.encode_and_decode(repeated, RANKS, vocab.PATTERN).count() == 7


def check_packing(rows, texts, library, length=2048):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in texts.items():
        ids, at = library.encode(t or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length])) and r.length > 0
            at += r.length
        assert at == len(ids)
    total = padding = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
        total, padding = total + at, padding + (0 if at & (at - 1) == 0 else length - at)
    return padding / total


def test_packing(docs, texts, byte_library):
    check_packing(packing.pack_documents(docs, BYTES).collect(), texts, byte_library)


def test_packing_of_the_whole_table(spark, sf_dir, byte_library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_packing(queries.QUERIES["op4_pack_sequences"](spark, sf_dir).collect(), texts, byte_library) < 0.03


def test_packing_in_runs(monkeypatch):
    monkeypatch.setattr(packing, "RUN_TOKENS", 5000)
    r = np.random.default_rng(4)
    packer, out, sizes = packing.Packer(256, 0, np.zeros(100, bool)), [], [7, 30_000, 1, 4990, 260]
    for k, n in enumerate(sizes):
        out += packer.add(k, r.integers(0, 100, n).astype("<u4"))
    out += packer.finish()
    assert packer.waiting == 0 and sum(x[2] for x in out) == sum(sizes)
    ends = {}
    for x in out:
        assert x[6] == ends.get(x[5], 0)
        ends[x[5]] = x[6] + x[2]
    assert max(ends.values()) <= 256 and list(ends) == list(range(len(ends)))


def test_cuts_are_the_cheapest():
    r = np.random.default_rng(3)
    for _ in range(200):
        steps = r.integers(1, 6, r.integers(1, 9))
        cuts, fines = np.cumsum(steps).tolist(), r.integers(0, 6, len(steps)).tolist()

        def cost(chosen):
            at, total = 0, 0
            for c in chosen:
                if c - at > 8:
                    return float("inf")
                total, at = total + 8 - (c - at) + fines[cuts.index(c)], c
            return total

        best = min(cost([*s, cuts[-1]]) for n in range(len(cuts)) for s in itertools.combinations(cuts[:-1], n))
        assert cost(packing.best_cuts(cuts, fines, 8)) == best


def test_section_counts(docs, texts, byte_library):
    got = {}
    for r in token_counts.section_tokens(docs, BYTES).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in texts.items():
        spans = token_counts.sections_of(t or "")
        offsets = byte_library.encode(t or "", add_special_tokens=False).offsets
        n, crossing = [0] * len(spans), [0] * len(spans)
        for a, b in offsets:
            shares = [min(b, e) - max(a, s) for s, e in spans]
            best = max(shares)
            k = shares.index(best) if best > 0 else max([j for j, (_, e) in enumerate(spans) if e <= a], default=0)
            n[k] += 1
            crossing[k] += a < spans[k][0] or b > spans[k][1]
        rows = sorted(got[i], key=lambda r: r.section)
        assert [(r.start, r.start + r.length) for r in rows] == spans
        assert [r.n_tokens for r in rows] == n and [r.n_crossing for r in rows] == crossing
        assert all(r.doc_tokens == len(offsets) for r in rows)


def test_sections_cover_every_line_with_text():
    text = "\n\na\nb\n\n \nc" + "\nd" * 20
    spans = token_counts.sections_of(text)
    assert [text[a:b] for a, b in spans[:1]] == ["a\nb\n"] and "".join(text[a:b] for a, b in spans).split() == text.split()


def check_pieces(rows, texts, library):
    for i, t in texts.items():
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        assert tuple(rows[i]) == (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_piece_model(docs, texts, rank_library):
    check_pieces(by_id(piece_bpe.encode_and_decode(docs, RANKS, vocab.PATTERN)), texts, rank_library)


def test_piece_model_of_the_whole_table(spark, sf_dir, rank_library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check_pieces(by_id(queries.QUERIES["op10_piece_bpe"](spark, sf_dir)), texts, rank_library)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_piece_model_equals_the_library(text):
    own, library = _rank_encoders()
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and own.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_many_texts_encode_as_each_alone(texts):
    for own in (encoder(WordEncoder, vocab.path("word_bpe_49k.json")), encoder(ByteEncoder, vocab.path("byte_bpe_50k.json")), _rank_encoders()[0]):
        assert [x.tobytes() for x in own.encode_all(texts)] == [own.encode(t) for t in texts]


def test_caches_are_bounded():
    """Long chunks are not remembered, and what is remembered is bounded by its characters."""
    own = ByteEncoder(vocab.path("byte_bpe_50k.json"))
    for k in range(300):
        own.encode_all([f"{k}" * 100 + " x", f"{k}  " + "日" * 90])
        own.encode(f"{k}" * 100)
    for cache in (own.cache, own.spaced, own.marked):
        assert max(map(len, cache), default=0) <= encoding.LONGEST
    many = encoding.Chunks(lambda c: b"1234")
    for k in range(0, 40_000, 100):
        many.each([f"{i:064}" for i in range(k, k + 100)])
        many.joined([f"{i:063}" for i in range(k, k + 100)])
    assert sum(map(len, many)) + sum(map(len, many.older)) <= 2 * (encoding.CACHE_CHARS + 100 * 64)


def _rank_encoders(made=[]):  # noqa: B006
    if not made:
        entries = piece_bpe.read_ranks(RANKS)
        made += [piece_bpe.PieceEncoder(f"{RANKS}\0{vocab.PATTERN}"),
                 tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={})]
    return made
