"""Spelling variants: words one edit apart, found by a bit-sliced position index, and chains of ever more frequent forms.

Index. A block of words is one bit per word. For every (position, letter) it has the set of words with that letter there. A
query word walks along its letters; three sets advance at once, each by a few operations on whole words of bits:

    same    words that agree with the query so far
    changed words with one letter replaced so far           (same positions)
    longer  words with one letter more so far               (positions shifted by one)
    shorter words with one letter less so far               (positions shifted back by one)

Which of the last three is used depends on the lengths: a block holds the words of one length, or of two lengths that follow
each other, whose pairs lie one replacement or one insertion apart.

Blocks. Two words one edit apart agree before and after the edit, so they share the first half of their letters or the last
half. Every word is filed by both halves, for its own length and the two pairs of lengths it belongs to. A pair that shares
both halves counts in the first only: a block by last letters leaves out words that agree with the query up to ``cut``, which
is the set ``same`` at that place. A block of more than BLOCK_WORDS words is divided by the same rule again, into blocks that
share more first or more last letters, down to all but the edited letter, where it holds a word per letter of the alphabet.
So no block meets whole in a task unless it is small, and no pair is lost or counted twice.

Of its blocks a word gets the number of its near words and the best of them, a row per block; pairs are never written out.

Defined results: a null text has no words; a null ``doc_id`` is the empty string in the deletion rule; repeated rows count as
often as they stand there; of near words of equal count the smallest in code-point order is the form; a table without words,
or an empty one, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import slices, small_batches
from flowlens.session import stored

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form must be so many times as frequent as the word.
TIMES = 10
#: One in so many (document, run) pairs loses a letter.
DELETED = 31
#: Words that one index holds at most; a larger block is divided.
BLOCK_WORDS = 2048
#: Distinct words a task gathers before it sends their counts on.
MOST_GATHERED = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Stands between the two halves of a block's key; no letter.
_BAR = "|"


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def observed(doc_id: int | None, text: str, least: int = LEAST_LENGTH) -> Counter:
    """Words of a text with their occurrences, after the deletion rule; shorter ones are left out."""
    found: Counter = Counter()
    for run, n in Counter(_RUN.findall(text)).items():
        if len(run) >= least:
            found[lowered(run)] += n
    out: Counter = Counter()
    start = crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run, n in found.items():
        h = crc32(run.encode(), start)
        if h % DELETED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n, len): every task adds up what it reads before it sends it on."""
    small_batches(docs.sparkSession)

    def run(batches):
        gathered: Counter = Counter()

        def rows():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(gathered), pa.string()), pa.array(list(gathered.values()), pa.int64())], ["word", "n"])
            gathered.clear()

        for part, texts in slices(batches):
            for doc_id, text in zip(part.column(0).to_pylist(), texts):
                gathered.update(observed(doc_id, text, least))
                if len(gathered) > MOST_GATHERED:
                    yield from rows()
        yield from rows()

    words = docs.where("text IS NOT NULL").select("doc_id", "text").mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count).withColumn("len", F.length("word"))


def _agree() -> Column:
    """Letters that a pair of the block shares at its two ends together, at least."""
    return F.when(F.col("mixed"), F.col("short")).otherwise(F.col("short") - 1)


def _divided(blocks: DataFrame) -> DataFrame:
    """Every row of a block in its two parts: more first letters shared, or more last letters and not those first ones.

    Rows: word, n, len, short (the smaller length of the block), mixed (two lengths), head and tail (letters shared), cut
    (pairs that share so many first letters belong elsewhere), key.
    """
    more = F.col("head") + F.ceil((_agree() - F.col("head") - F.col("tail")) / 2).cast("int")
    first = F.struct(more.alias("head"), F.col("tail"), F.col("cut"))
    last = F.struct(F.col("head"), (_agree() + 1 - more).alias("tail"), F.least("cut", more).alias("cut"))
    # where the first part holds no pair that is counted here, only the second is made
    parts = F.explode(F.when(more < F.col("cut"), F.array(first, last)).otherwise(F.array(last)))
    rows = blocks.withColumn("part", parts).select("word", "n", "len", "short", "mixed", "part.*")
    key = F.concat_ws(_BAR, "short", "mixed", "cut", "tail", F.substring("word", F.lit(1), F.col("head")),
                      F.when(F.col("tail") > 0, F.expr("right(word, tail)")).otherwise(""))
    return rows.withColumn("key", key)


def _first_blocks(words: DataFrame) -> DataFrame:
    """Every word in the block of its length and the two of neighbouring lengths, divided once."""
    kind = F.explode(F.array(
        F.struct(F.col("len").alias("short"), F.lit(False).alias("mixed")),
        F.struct(F.col("len").alias("short"), F.lit(True).alias("mixed")),
        F.struct((F.col("len") - 1).alias("short"), F.lit(True).alias("mixed"))))
    whole = words.select("word", "n", "len", kind.alias("kind")).select(
        "word", "n", "len", "kind.*", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(1 << 30).alias("cut"))
    return _divided(whole)


class PositionIndex:
    """Sets of words, one bit each, by position and letter.

    ``begin`` is the number of first letters that all words of the block share, ``stop`` the first place that is never asked
    for. In the three searches ``end`` is the query's place behind which all words of the block agree with it.
    """

    def __init__(self, words: list[str], begin: int, stop: int):
        self.sets: dict[tuple[int, str], int] = {}
        sets = self.sets
        for i, word in enumerate(words):
            bit = 1 << i
            for at in enumerate(word[begin:stop], begin):
                sets[at] = sets.get(at, 0) | bit
        self.begin, self.all = begin, (1 << len(words)) - 1

    def _agreeing(self, query: str, first: int) -> int:
        """Words that share the query's ``first`` first letters, none if it has fewer."""
        same = self.all if first <= len(query) else 0
        for j in range(self.begin, first if same else 0):
            same &= self.sets.get((j, query[j]), 0)
        return same

    def replaced(self, query: str, end: int, cut: int) -> int:
        """Words of the query's length with exactly one letter replaced before ``end``, not sharing ``cut`` first letters."""
        get, same, changed = self.sets.get, self.all, 0
        for j in range(self.begin, end):
            here = get((j, query[j]), 0)
            changed = changed & here | same & ~here
            same &= here
        return changed and changed & ~self._agreeing(query, cut)

    def longer(self, query: str, end: int, cut: int) -> int:
        """Words that have one letter more up to the query's place ``end``, not sharing ``cut`` first letters."""
        get, same, more = self.sets.get, self.all, 0
        for j in range(self.begin, end):
            c = query[j]
            more = (more | same) & get((j + 1, c), 0)
            same &= get((j, c), 0)
        more |= same
        return more and more & ~self._agreeing(query, cut)

    def shorter(self, query: str, end: int, cut: int) -> int:
        """Words that have one letter less before the query's place ``end``, not sharing ``cut`` first letters."""
        get, same, less = self.sets.get, self.all, 0
        for j in range(self.begin, end):
            c = query[j]
            less = less & get((j - 1, c), 0) | same
            same &= get((j, c), 0)
        return less and less & ~self._agreeing(query, cut)


def near_in_block(words: list[str], n: list[int], short: int, mixed: bool, head: int, tail: int, cut: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count among them, the smallest near word of that count) of the words of one block."""
    # bits in order of preference, so that the best of a set is its lowest bit
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    words, n = [words[i] for i in order], [n[i] for i in order]
    stop = max(short + 1 - tail, cut if cut <= short else 0)
    if not mixed:
        index = PositionIndex(words, head, stop)
        found = ((w, index.replaced(w, short - tail, cut), words, n) for w in words)
    else:
        small, large = ([i for i, w in enumerate(words) if len(w) == size] for size in (short, short + 1))
        if not small or not large:
            return
        (few, few_n), (many, many_n) = (([words[i] for i in part], [n[i] for i in part]) for part in (small, large))
        of_large, of_small = PositionIndex(many, head, stop), PositionIndex(few, head, stop)
        found = [(w, of_large.longer(w, short - tail, cut), many, many_n) for w in few]
        found += [(w, of_small.shorter(w, short + 1 - tail, cut), few, few_n) for w in many]
    for word, near, others, counts in found:
        if near:
            best = (near & -near).bit_length() - 1
            yield word, near.bit_count(), counts[best], others[best]


def _judged(blocks: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): a row per word and block in which it has near words; blocks stream through the tasks."""
    names = ["word", "n_near", "best_n", "best"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        key, words, n, kind, out = None, [], [], (), []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for k, word, count, *own in zip(*columns):
                if k != key:
                    if len(words) > 1:
                        out += near_in_block(words, n, *kind)
                    key, words, n, kind = k, [], [], own
                words.append(word)
                n.append(count)
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                out = []
        if len(words) > 1:
            out += near_in_block(words, n, *kind)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    ordered = blocks.select("key", "word", "n", "short", "mixed", "head", "tail", "cut").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "word string, n_near long, best_n long, best string")


def near_words(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n, len) that have near words."""
    found = None
    blocks = _first_blocks(words)
    while True:
        blocks = stored(blocks, "spelling-blocks")
        large = stored(blocks.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most).select("key"), "large-blocks")
        hot = not large.isEmpty()
        # what has no letter left to share but the edited one is bounded by the alphabet and is not divided further
        open_ = F.col("head") + F.col("tail") < _agree()
        done = blocks.join(large.withColumn("large", F.lit(True)), "key", "left").where(~(F.col("large").isNotNull() & open_)) if hot else blocks
        part = _judged(done)
        found = part if found is None else found.unionByName(part)
        if not hot:
            break
        blocks = _divided(blocks.where(open_).join(large, "key", "left_semi").drop("key"))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))


def grouped(words: DataFrame, times: int = TIMES, most: int = BLOCK_WORDS) -> DataFrame:
    """One row per word of (word, n, len): word, form, root, n, n_near, form_n.

    A form is at least ``times`` as frequent as its word, so a chain has few links: every round follows one more for the
    words whose last form has a form itself, until none has.
    """
    near = near_words(words, most)
    is_form = F.col("best_n") >= times * F.col("n")
    rows = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    links = rows.where("form IS NOT NULL").select(F.col("word").alias("from"), F.col("form").alias("to"))
    ends, going, level = [], links.select(F.col("from").alias("word"), F.col("to").alias("root")), 0
    while True:
        going = stored(going.join(links, F.col("root") == F.col("from"), "left").select("word", "root", "to"), f"spelling-chain-{level}")
        ends.append(going.where("to IS NULL").select("word", "root"))
        going = going.where("to IS NOT NULL").select("word", F.col("to").alias("root"))
        level += 1
        if going.isEmpty():
            break
    roots = ends[0]
    for part in ends[1:]:
        roots = roots.unionByName(part)
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame) -> DataFrame:
    """Spelling groups of the words of all whole texts: word, form, root, n, n_near, form_n."""
    return grouped(stored(vocabulary(docs), "spelling-words"))
