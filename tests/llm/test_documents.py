"""Deduplication, quality, licences and language model against plain Python."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowlens.llm import dart_minhash, exact_dedup, hidden_markov, licenses, quality_rules, queries, run_length_index

from . import brute
from .conftest import by_id, passage

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def table_texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def plain(texts):
    return {i: t or "" for i, t in texts.items()}


def check(rows, expected, columns):
    assert {i: tuple(r[c] for c in columns) for i, r in rows.items()} == expected


REMOVED = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats(docs, plain):
    check(by_id(run_length_index.remove_repeats(docs)), brute.repeats(plain), REMOVED)


def test_repeats_of_the_whole_table(spark, sf_dir, table_texts):
    check(by_id(queries.QUERIES["op3_repeated_passages"](spark, sf_dir)), brute.repeats(table_texts), REMOVED)


@pytest.mark.parametrize("most", [0, 3])
def test_repeats_in_large_groups_are_refined(spark, monkeypatch, most):
    """A passage between ends that differ, agree by chance or are cut: every group is taken for a large one."""
    monkeypatch.setattr(run_length_index, "GROUP_SLICES", most)
    shared = passage(31, 130)
    rows = [passage(40 + i, 60)[: 7 * i] + "ab" * (i % 3) + shared[i % 2 * 20 : len(shared) - i % 5 * 3] + "c" * (i % 4) + passage(60 + i, 9 * i)
            for i in range(14)] + ["z" * 900, "xy" * 600]
    texts = dict(enumerate(rows))
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    check(by_id(run_length_index.remove_repeats(df)), brute.repeats(texts), REMOVED)


def test_strings_whose_polynomial_hashes_agree_are_told_apart(spark):
    """Thue-Morse strings and their complements have equal polynomials modulo 2^64; texts that share 300 bytes keep them."""
    signs = [bin(i).count("1") % 2 for i in range(256)]
    shared = passage(51, 60).encode()[:300].decode(errors="ignore")
    texts = {}
    for k, (x, y) in enumerate(itertools.combinations("abcdeXYZ", 2)):
        both = shared[: -8] + f" {x}{y}{k:04} "
        texts[2 * k] = both + "".join((x, y)[b] for b in signs)
        texts[2 * k + 1] = both + "".join((y, x)[b] for b in signs)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(by_id(run_length_index.remove_repeats(df)), brute.repeats(texts), REMOVED)


@pytest.mark.parametrize("least", [150, 250])
def test_shorter_repeats(spark, docs, plain, least):
    check(by_id(run_length_index.remove_repeats(docs, least)), brute.repeats(plain, least), REMOVED)


def test_ranges_cover_a_slice():
    data = bytes(range(256)) * 3
    for n, place, width in ((273, 272, 64), (100, 150, 16), (1, 0, 256), (5, 4, 1)):
        part = data[: n + run_length_index.LEAST - 1]
        found = list(run_length_index.ranges_of(part, place, width))
        assert [i for first, size, _, _ in found for i in range(first, first + size)] == list(range(n))
        for first, size, core, piece in found:
            for i in range(first, first + size):
                assert core in part[i : i + run_length_index.LEAST] and len(piece) == size + run_length_index.LEAST - 1


def test_repeats_of_no_rows_and_repeated_rows(no_docs, repeated):
    assert run_length_index.remove_repeats(no_docs).count() == 0
    rows = run_length_index.remove_repeats(repeated).collect()
    assert len(rows) == 7 and sorted(r.n_bytes - r.n_removed for r in rows)[:6] == [0] * 6


def test_stripped_documents_keep_their_columns(docs, plain):
    out = run_length_index.strip_repeats(docs)
    assert out.dtypes == docs.dtypes
    expected = brute.repeats(plain)
    for i, r in by_id(out).items():
        assert (r.text is None) == (i in (1, 18)) and len((r.text or "").encode()) <= expected[i][0] - expected[i][1] and r.n_chars in (None, len(r.text or ""))


def test_matching_statistics():
    r = np.random.default_rng(5)
    for _ in range(60):
        parts = [bytes(r.integers(97, 99, r.integers(1, 40)).astype("u1")) for _ in range(r.integers(1, 6))]
        index = run_length_index.RunLengthIndex(parts)
        found, at = index.matching_statistics(), 0
        suffixes = {(k, i): p[i:] for k, p in enumerate(parts) for i in range(len(p))}
        for k, p in enumerate(parts):
            for i in range(len(p)):
                common = [len([1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(p[i:], s))]) for key, s in suffixes.items() if key != (k, i)]
                assert found[at + i] == max(common, default=0)
            at += len(p) + 1
        assert index.lengths.sum() == at and len(index.run_starts) == len(index.letters) - 1


def test_slices_cover_every_start_once():
    data = passage(11, 30_000).encode()
    allowed = np.zeros(len(data), bool)
    allowed[: len(data) - run_length_index.LEAST + 1] = True
    seen = np.zeros(len(data), int)
    for _, at, size, _ in run_length_index.anchored_slices(data, allowed):
        for a, n in zip(at, size):
            seen[a : a + n] += 1
    assert (seen == allowed).all()


COUNTS = (*quality_rules.BASE, "base_failed")


def labelled(spark, texts):
    bad = {i for i in texts if brute.quality(texts[i])[2] > 5}
    return spark.createDataFrame([(i, int(i not in bad), 0) for i in texts] + [(None, 1, 0), (3, None, 0)], LABELS)


def test_quality(spark, docs, plain):
    rows = by_id(quality_rules.judge(docs, labelled(spark, plain)))
    check(rows, {i: brute.quality(t) for i, t in plain.items()}, COUNTS)
    assert not any(r.kept and r.base_failed for r in rows.values())


def test_quality_of_the_whole_table(spark, sf_dir, table_texts):
    check(by_id(queries.QUERIES["op5_decision_list"](spark, sf_dir)), {i: brute.quality(t) for i, t in table_texts.items()}, COUNTS)


def test_quality_of_no_rows_no_labels_and_repeated_rows(spark, docs, no_docs, repeated):
    none = spark.createDataFrame([], LABELS)
    assert quality_rules.judge(no_docs, none).count() == 0 and quality_rules.judge(repeated, none).count() == 7
    assert quality_rules.keep_good(docs, none).columns == docs.columns


def test_decision_list_holds_out(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    learned, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rules = quality_rules.learn_rules(docs, learned)
    rows = quality_rules.base_statistics(docs.join(F.broadcast(rest.select("doc_id")), "doc_id"))
    rows = rows.where(~quality_rules.base_failed()).select("doc_id", quality_rules.verdict(rules).alias("kept")).join(rest, "doc_id")
    found = {(r.quality, r.kept): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    good, bad = found.get((1, True), 0), found.get((0, False), 0)
    assert good >= 0.99 * (good + found.get((1, False), 0)) and bad >= 0.9 * (bad + found.get((0, True), 0))


def test_rules_cover_planted_conditions():
    r = np.random.default_rng(2)
    values = r.uniform(0, 1, (3000, len(quality_rules.STATISTICS)))
    bad = ((values[:, 2] > 0.7) & (values[:, 3] <= 0.5)) | (values[:, 5] > 0.95)
    rules = quality_rules.learn(values, bad)
    hit = np.any([quality_rules._covers(rule, values) for rule in rules], axis=0)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.02 * (~bad).sum()
    assert quality_rules.learn(values, np.zeros(3000, bool)) == [] and quality_rules.learn(values[:0], bad[:0]) == []


LICENCE = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def test_licenses(docs, plain, no_docs, repeated):
    rows = by_id(licenses.scan_licenses(docs))
    check(rows, {i: brute.licenses(t) for i, t in plain.items()}, LICENCE)
    assert rows[14].labels == "apache-2.0,cc-by,cc-by-nc,gpl-2.0-only,mit,reserved" and rows[14].score == 1.0
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert licenses.scan_licenses(no_docs).count() == 0 and licenses.scan_licenses(repeated).count() == 7


def test_licenses_of_the_whole_table(spark, sf_dir, table_texts):
    check(by_id(queries.QUERIES["op6_license_scan"](spark, sf_dir)), {i: brute.licenses(t) for i, t in table_texts.items()}, LICENCE)


@pytest.mark.parametrize("text, labels, score", [
    ("SPDX-License-Identifier: MIT", "mit", 0.1), ("spdx license  identifier\n:\tMIT)", "mit", 0.1),
    ("myspdx-license-identifier: foo\nSPDX-License-Identifier: mit", "mit", 0.1), ("myspdx-license-identifier: foo", "", 0.0),
    ("é日 SPDX-License-Identifier: isc é SPDX-License-Identifier: (mit or", "invalid-expression,isc", 0.5),
    ("SPDX-License-Identifier: bsd-3-clause SPDX-License-Identifier: agpl-3.0", "agpl-3.0,bsd-3-clause", 0.8),
    ("SPDX-License-Identifier", "invalid-expression", 0.5), ("SPDX-License-Identifier: \u00a0mit", "invalid-expression", 0.5),
    ("Altered source versions must be plainly marked as such, and", "zlib", 0.1),
    ("Neither the name of the copyright holder\n * nor the names of its contributors", "bsd-3-clause", 0.1)])
def test_tags_and_notices(text, labels, score):
    found = licenses.Scanner().scan(text)
    assert found[5] == labels and math.isclose(found[6], score)


def test_many_tags_in_one_text():
    found = licenses.Scanner().scan("é SPDX-License-Identifier: x1 " * 20_000 + "SPDX-License-Identifier: mit")
    assert found[5] == "mit,x1" and found[0] == 5 * 20_000 + 4


@pytest.mark.parametrize("text, names, score", [
    ("mit", {"mit"}, 0.1), ("mit or gpl-2.0-only", {"mit", "gpl-2.0-only"}, 0.1), ("mit and gpl-2.0-only or isc", {"mit", "gpl-2.0-only", "isc"}, 0.1),
    ("mit and (gpl-2.0-only or agpl-3.0)", {"mit", "gpl-2.0-only", "agpl-3.0"}, 0.6),
    ("gpl-2.0-only with classpath-exception-2.0 and mit. more words", {"gpl-2.0-only", "classpath-exception-2.0", "mit"}, 0.48),
    ("strange-licence some text", {"strange-licence"}, 0.5)])
def test_expressions(text, names, score):
    found = licenses.evaluate(text)
    assert found[0] == names and math.isclose(found[1], score)


@pytest.mark.parametrize("text", ["", "and mit", "(mit or", "mit or", "mit and and isc", "()"])
def test_broken_expressions(text):
    assert licenses.evaluate(text) is None


GROUP = ("keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups(docs, plain, no_docs):
    check(by_id(exact_dedup.exact_groups(docs)), brute.exact(plain), GROUP)
    assert exact_dedup.exact_groups(no_docs).count() == 0 and exact_dedup.keep_first(no_docs).count() == 0


def test_exact_groups_with_one_digest_for_different_texts(docs, plain):
    weak = exact_dedup.exact_groups(docs, digest=lambda text: (F.length(text) % 3).cast("string"))
    check(by_id(weak), brute.exact(plain), GROUP)


def test_exact_dedup_keeps_one_row_of_each_group(docs, plain, repeated):
    out = exact_dedup.keep_first(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, v in brute.exact(plain).items() if v[2])
    rows = exact_dedup.exact_groups(repeated)
    assert rows.count() == 7 and sorted(r.doc_id for r in rows.where("kept").collect()) == [3, 4, 9]
    assert sorted(r.doc_id for r in exact_dedup.keep_first(repeated).collect()) == [3, 4, 9]


def test_near_classes(docs, plain):
    rows = by_id(dart_minhash.near_classes(docs))
    assert {i: r.class_id for i, r in rows.items()} == brute.near(plain)
    kept = dart_minhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == set(brute.near(plain).values())


def test_near_classes_of_the_whole_table(spark, sf_dir, table_texts):
    rows = by_id(queries.QUERIES["op8_near_classes"](spark, sf_dir))
    expected = brute.near(table_texts)
    assert {i: r.class_id for i, r in rows.items()} == expected
    sizes = {c: list(expected.values()).count(c) for c in expected.values()}
    assert all(r.class_size == sizes[expected[i]] and r.kept == (expected[i] == i) for i, r in rows.items())


def test_near_classes_of_no_rows_and_repeated_rows(no_docs, repeated):
    assert dart_minhash.near_classes(no_docs).count() == 0
    rows = dart_minhash.near_classes(repeated).collect()
    assert len(rows) == 7 and sorted(r.class_size for r in rows) == [1, 1, 1, 4, 4, 4, 4]


def edited(words: list, seed: int, places: int, new: str) -> list:
    """A copy with so many words replaced, none within reach of a shingle of another."""
    at = random.Random(seed).sample(range(5, len(words) - 5, 5), places)
    return [f"{new}{k}" if k in at else w for k, w in enumerate(words)]


def test_near_pairs_between_texts_of_a_template(spark):
    """Texts below 0.8 to each other, and pairs among them above: a bucket of the template holds them all."""
    base = passage(30, 504).split(" ")
    texts = {i: edited(base, i, 8, f"own{i}x") for i in range(300)}
    texts |= {1000 + i: edited(texts[i], 1000 + i, 8, f"more{i}x") for i in range(0, 300, 2)}
    texts = {i: " ".join(w) for i, w in texts.items()}
    expected = brute.near(texts)
    assert len(set(expected.values())) > 250
    rows = by_id(dart_minhash.near_classes(spark.createDataFrame([(t, i) for i, t in texts.items()], "text string, doc_id long")))
    assert {i: r.class_id for i, r in rows.items()} == expected


def test_near_copies_around_one_original(spark):
    """Copies below 0.8 to each other and above it to the original, which the rounds hide behind its class."""
    base = passage(30, 504).split(" ")
    words = {0: base} | {i: edited(base, i, 9, f"own{i}x") for i in range(1, 301)}
    rows = by_id(dart_minhash.near_classes(spark.createDataFrame([(" ".join(w), i) for i, w in words.items()], "text string, doc_id long")))
    assert {r.class_id for r in rows.values()} == {0}


def test_signatures_agree_as_often_as_sets():
    base = passage(20, 900).split(" ")
    for changed, width in ((0, 0.0), (40, 0.1), (150, 0.1)):
        other = [w if k >= changed else f"new{k}" for k, w in enumerate(base)]
        a, b = (dart_minhash.cells(" ".join(x)) for x in (base, other))
        similar = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = dart_minhash.signatures([a, b])
        assert abs((x == y).mean() - similar) <= width and (x != 0).all()


def test_components(spark):
    chain = [(bytes([i + 1]), bytes([i])) for i in range(30)] + [(b"\x50", b"\x51"), (b"\x52", b"\x51")]
    rows = {bytes(r.node): bytes(r.label) for r in dart_minhash.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert all(rows[bytes([i])] == b"\x00" for i in range(31)) and {rows[bytes([i])] for i in (0x50, 0x51, 0x52)} == {b"\x50"}


def test_components_by_rounds_and_in_one_task_are_the_same(spark, monkeypatch):
    r = random.Random(3)
    edges = spark.createDataFrame([(bytes([r.randrange(250)]), bytes([r.randrange(250)])) for _ in range(120)], "a binary, b binary")
    here = sorted(map(tuple, dart_minhash.components(edges).collect()))
    monkeypatch.setattr(dart_minhash, "HERE", 0)
    assert here == sorted(map(tuple, dart_minhash.components(edges).distinct().collect()))


def score_rows(rows, expected):
    for i, e in expected.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4] and math.isclose(r.base_score, e[4], rel_tol=1e-9)
        assert r.score < 0


def test_scores(docs, plain, no_docs, repeated):
    score_rows(by_id(hidden_markov.score(docs, states=3, buckets=64, rounds=2)), brute.base_scores(plain))
    assert hidden_markov.score(no_docs, rounds=1).count() == 0 and hidden_markov.score(repeated, rounds=1).count() == 7


def test_scores_of_the_whole_table(spark, sf_dir, table_texts):
    score_rows(by_id(queries.QUERIES["op9_hidden_markov"](spark, sf_dir)), brute.base_scores(table_texts))


def tiny_model(states=2, letters=3):
    r = np.random.default_rng(9)
    part = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(r.uniform(0.1, 1, shape))
    return hidden_markov.Model(part(states), part(states, states), part(states, letters).T)


def paths(model, seq):
    """(probability, states) of every state sequence."""
    for z in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[z[0]] * model.emit[seq[0], z[0]]
        for k in range(1, len(seq)):
            p *= model.move[z[k - 1], z[k]] * model.emit[seq[k], z[k]]
        yield p, z


def test_likelihood_and_counts_equal_enumeration():
    model, seqs = tiny_model(), [[0, 1, 2, 2, 1], [2], [1, 1, 0]]
    flat, lengths = np.concatenate(seqs), np.array([len(s) for s in seqs])
    assert np.allclose(hidden_markov.log_likelihood(model, flat, lengths), [math.log(sum(p for p, _ in paths(model, s))) for s in seqs])
    starts, moves, emissions = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s in seqs:
        total = sum(p for p, _ in paths(model, s))
        for p, z in paths(model, s):
            starts[z[0]] += p / total
            for k, state in enumerate(z):
                emissions[s[k], state] += p / total
                if k:
                    moves[z[k - 1], state] += p / total
    for found, expected in zip(hidden_markov.expected_counts(model, flat, lengths), (starts, moves, emissions)):
        assert np.allclose(found, expected)


def test_training_raises_the_held_out_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = []
    for rounds in (0, 4):
        r = hidden_markov.score(docs, rounds=rounds).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
        held.append(r[0] / r[1])
    assert held[1] > held[0]


def test_pipeline(spark, sf_dir, table_texts):
    """Every stage against its plain version on what the stage before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test-stage")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = by_id(queries.QUERIES["op5_decision_list"](spark, sf_dir))
    assert set(kept["quality rules"]) == {i for i, r in good.items() if r.kept}
    first = {i for i, v in brute.exact(kept["quality rules"]).items() if v[2]}
    assert set(kept["exact dedup"]) == first
    assert set(kept["near dedup"]) == set(brute.near(kept["exact dedup"]).values())
    left = brute.repeats(kept["near dedup"], corpus_pipeline.PASSAGE_BYTES)
    assert {i: len(t.encode()) for i, t in kept["repeated passages"].items()} == {i: v[0] - v[1] for i, v in left.items()}
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(kept["repeated passages"])
