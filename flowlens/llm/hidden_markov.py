"""Language model scoring by a hidden Markov model over hashed words.

Training: Baum-Welch. Every task adds up the expected counts of its training documents, cut into segments of SEGMENT tokens,
by scaled forward and backward recursions; the counts are summed over all tasks and give the next model. The emission table
has a fixed number of word buckets, so the model has a fixed size; which word of its bucket occurs is told by corpus counts.

    P(text) = P(buckets of its tokens) * product of P(word | its bucket)

Scoring runs the scaled forward recursion over the whole token sequence of every document: an exact likelihood, no cut.

Counts of words are a distributed table of any size. Documents lie in blocks by hash of their id and text; every block gets the counts
of just the words it holds by a join, so neither the table nor the vocabulary passes through one machine.

Defined results: null and empty texts are the end token alone; a null ``doc_id`` counts as the empty string for the split;
repeated rows are documents of their own; with no training document every count is 0 and the model is the uniform start;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import slices, small_batches, text_of
from flowlens.session import stored

STATES, BUCKETS, ROUNDS = 6, 8192, 3
SEGMENT = 256
#: Tokens' worth of unigram that smooth each state's emissions.
SMOOTHING = 50.0
BLOCK_BYTES = 8 << 20
#: Distinct words a task gathers before it sends their counts on.
MOST_GATHERED = 400_000


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), as UTF-8; the end token is not among them."""
    return text.encode().lower().split()


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


@dataclass(frozen=True)
class Model:
    """start (S), move (S x S), emit (buckets + 1 x S; the last bucket is the end token)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def symbols(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word, and the end token's after the last."""
    out = np.empty(len(words) + 1, "i4")
    out[:-1] = np.fromiter(map(crc32, words), "u4", len(words)) % buckets
    out[-1] = buckets
    return out


def first_model(unigram: np.ndarray, states: int) -> Model:
    """Every state near the corpus, told apart by a fixed noise."""
    noise = np.random.default_rng(1).uniform(0.5, 1.5, (len(unigram), states))
    emit = unigram[:, None] * noise
    move = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences longest first, where each begins, and how many are longer than t for every t."""
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    most = int(lengths.max()) if len(lengths) else 0
    alive = len(lengths) - np.cumsum(np.bincount(lengths, minlength=most + 1))[:most] if most else np.empty(0, int)
    return order, begins, alive


def log_likelihood(model: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of P(sequence) for sequences laid end to end; all of them advance together, one token at a time."""
    order, begins, alive = _by_length(lengths)
    found = np.zeros(len(lengths))
    alpha = None
    for t, k in enumerate(alive):
        emitted = model.emit[flat[begins[:k] + t]]
        alpha = (model.start if alpha is None else alpha[:k] @ model.move) * emitted
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        found[:k] += np.log(scale)
    out = np.empty(len(lengths))
    out[order] = found
    return out


def expected_counts(model: Model, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts (S), moves (S x S) and emissions (buckets + 1 x S) of the sequences under the model."""
    order, begins, alive = _by_length(lengths)
    states = len(model.start)
    starts, moves, emissions = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    alphas, scales = [], []
    for t, k in enumerate(alive):
        alpha = (alphas[-1][:k] @ model.move if t else model.start) * model.emit[flat[begins[:k] + t]]
        scales.append(alpha.sum(1)[:, None])
        alphas.append(alpha / scales[-1])
    seen, weights = [], []
    beta = None
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        here = flat[begins[:k] + t]
        now = np.ones((k, states))
        if beta is not None:
            n = alive[t + 1]
            ahead = model.emit[flat[begins[:n] + t + 1]] * beta / scales[t + 1]
            moves += alphas[t][:n].T @ ahead
            now[:n] = ahead @ model.move.T
        gamma = alphas[t] * now
        if t == 0:
            starts += gamma.sum(0)
        seen.append(here)
        weights.append(gamma)
        beta = now
    if seen:
        at, w = np.concatenate(seen), np.concatenate(weights)
        for s in range(states):
            emissions[:, s] = np.bincount(at, w[:, s], len(model.emit))
    return starts, moves * model.move, emissions


def segments(lengths: list[int], most: int = SEGMENT) -> np.ndarray:
    """Lengths after cutting every sequence into pieces of at most ``most``."""
    out: list[int] = []
    for n in lengths:
        out += [most] * (n // most) + ([n % most] if n % most else [])
    return np.array(out, "i8")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("text"), held_out().alias("held_out"))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) over all training documents; every task sends on what it has added up."""

    def count(batches):
        gathered: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(gathered), pa.binary()), pa.array(list(gathered.values()), pa.int64())], ["word", "n"])

        for _, texts in slices(batches):
            for text in texts:
                gathered.update(tokens(text))
            if len(gathered) > MOST_GATHERED:
                yield rows()
                gathered.clear()
        if gathered:
            yield rows()

    return training.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def train(training: DataFrame, unigram: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all documents; per round the driver receives one row per bucket and state, whatever the corpus."""
    buckets = len(unigram) - 1
    model = first_model(unigram, states)
    columns = [f"s{i}" for i in range(states)]

    for _ in range(rounds):

        def gather(batches, model=model):
            total = None
            for _, texts in slices(batches):
                each = [symbols(tokens(t), buckets) for t in texts]
                found = expected_counts(model, np.concatenate(each), segments([len(x) for x in each]))
                total = found if total is None else tuple(a + b for a, b in zip(total, found))
            if total is not None:
                rows = np.concatenate([total[2], total[1], total[0][None]])
                used = np.flatnonzero(rows.any(1))
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(rows[used, i]) for i in range(states))],
                                                 ["at", *columns])

        summed = (training.select("text").mapInArrow(gather, "at long, " + ", ".join(f"{c} double" for c in columns))
                  .groupBy("at").agg(*(F.sum(c).alias(c) for c in columns)).collect())
        table = np.zeros((buckets + 1 + states + 1, states))
        for row in summed:
            table[row[0]] = row[1:]
        if not table.any():
            return model
        emissions, moves, starts = table[: buckets + 1], table[buckets + 1 : -1], table[-1]
        emit = emissions + SMOOTHING * unigram[:, None]
        move = moves + 1.0
        model = Model((starts + 1) / (starts + 1).sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def score(docs: DataFrame, states: int = STATES, buckets: int = BUCKETS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    spark = docs.sparkSession
    small_batches(spark)
    every = _documents(docs)
    training = every.where(~F.col("held_out"))
    counts = stored(word_counts(training), "word-counts")
    size = every.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum((~F.col("held_out")).cast("long")).alias("training")).first()
    n_docs, blocks = size["training"] or 0, max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES))
    in_bucket = np.zeros((buckets + 1, 2))
    for b, c, v in counts.groupBy((F.crc32("word") % buckets).alias("b")).agg(F.sum("c"), F.count(F.lit(1))).collect():
        in_bucket[b] = c, v
    in_bucket[buckets] = n_docs, 1 if n_docs else 0
    n_all, n_distinct = int(in_bucket[:, 0].sum()), int(in_bucket[:, 1].sum())
    unigram = (in_bucket[:, 0] + 0.5) / (in_bucket[:, 0] + 0.5).sum()
    model = train(training, unigram, states, rounds)

    # log10 P(word | bucket) = log10(c + 0.5) - share[bucket]; the end token is the only word of its bucket
    share = np.log10(in_bucket[:, 0] + 0.5 * (in_bucket[:, 1] + 1))
    of_base = np.log10(n_all + 0.5 * (n_distinct + 1))
    in_blocks = every.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    def words_of(batches):
        seen: dict[int, set[bytes]] = {}

        def rows():
            for block, words in seen.items():
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(words), pa.int32()), pa.array(list(words), pa.binary())], ["block", "word"])
            seen.clear()

        for part, texts in slices(batches):
            for block, text in zip(part.column(3).to_pylist(), texts):
                seen.setdefault(block, set()).update(tokens(text))
            if sum(map(len, seen.values())) > MOST_GATHERED:
                yield from rows()
        yield from rows()

    known = in_blocks.mapInArrow(words_of, "block int, word binary").join(counts, "word").select("block", "word", "c")

    def judge(part: pa.Table, table: pa.Table) -> pa.Table:
        c_of = dict(zip(table.column("word").to_pylist(), table.column("c").to_pylist()))
        flat, lengths, base, words_part, n_known = [], [], [], [], []
        for text in part.column("text").to_pylist():
            words = tokens(text)
            c = np.append(np.fromiter(map(c_of.get, words, repeat(0)), "i8", len(words)), n_docs)
            at = symbols(words, buckets)
            logs = np.log10(c + 0.5)
            flat.append(at)
            lengths.append(len(at))
            base.append(logs.sum() - len(at) * of_base)
            words_part.append(logs[:-1].sum() - share[at[:-1]].sum())
            n_known.append(int((c > 0).sum()))
        found = log_likelihood(model, np.concatenate(flat), np.array(lengths, "i8")) / np.log(10) if flat else np.empty(0)
        return pa.table({
            "doc_id": part.column("doc_id").cast(pa.int64()), "held_out": part.column("held_out"),
            "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([n_all] * len(lengths), pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(found + np.array(words_part, float), pa.float64())})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return in_blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(judge, schema)
