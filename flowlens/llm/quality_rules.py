"""Learned decision lists over text statistics, DataFrame functions only.

Statistics of every text are Spark expressions. From the labelled documents' statistics, sequential covering learns rules that
reject: a rule starts empty and grows by the threshold that gains most (FOIL gain) on two thirds of the rows, loses its last
conditions as long as that helps on the other third, and is accepted if enough of what it covers there is bad; what it covers
is set aside, and the next rule is grown on the rest. The list becomes one ordered ``CASE WHEN`` expression.

The labelled sample is bounded: at most SAMPLE labelled documents, those with the smallest hash of ``doc_id``; only their
numbers reach the driver. Everything else is computed over all rows.

Defined results: null and empty texts have no words, so the base rule rejects them; without labels the list is empty and
rejects nothing more; repeated rows give a row each; other columns are ignored; an empty table gives no rows. Windows of five
words are told apart by a 64-bit hash inside their own text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import text_of

#: Labelled documents that rules are learned from.
SAMPLE = 5000
MAX_RULES, MAX_CONDITIONS = 12, 4
#: Least share of bad rows among those a rule covers, of grown and of set-aside rows, and least rows covered.
LEAST_PRECISION, LEAST_COVERED = 0.95, 8
#: Candidate thresholds per statistic.
THRESHOLDS = 64
SPACE = " \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("n_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "words_per_line", "digit_share")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _count_of(text: Column, letters: str) -> Column:
    """Characters of a class; most texts have none, which one search finds out."""
    found = F.length(text) - F.length(F.regexp_replace(text, f"[{letters}]+", ""))
    return F.when(F.rlike(text, F.lit(f"[{letters}]")), found).otherwise(0).cast("long")


def _covered(windows: Column, width: int) -> Column:
    """Words that lie in a window whose value occurs twice or more."""

    def starts(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return _let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda e, k: ((k > 0) & (F.get(s, k - 1)["x"] == e["x"])) | (F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False)))),
            lambda e: e["i"])))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda at, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - at, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(
        _let(starts(windows), total))


def _repeat_words(words: Column, width: int = 5) -> Column:
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(width))))
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(
        _let(hashes, lambda h: _let(windows(h), lambda w: _covered(w, width))))


def base_statistics(docs: DataFrame, *carried: Column) -> DataFrame:
    """The carried columns (doc_id by default), the BASE columns, and those that ``statistics`` needs, of every document.

    The numbers come out of a generator, so filters on them are not evaluated a second time below it.
    """
    trimmed = F.btrim(F.col("__text"), F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    of_words = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    of_lines = _let(F.filter(F.split("__text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    text = F.col("__text")
    numbers = F.struct(of_words.alias("__w"), of_lines.alias("__l"), _count_of(text, "#*$%&|<>").alias("n_symbols"),
                       _count_of(text, "0-9").alias("digits"))
    kept = docs.select(*(carried or [F.col("doc_id")]), text_of().alias("__text"))
    return kept.select(*kept.drop("__text").columns, F.inline(F.array(numbers))).select("*", "__w.*", "__l.*").drop("__w", "__l")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The numbers that conditions test, from the columns of ``base_statistics``; never null."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"), "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"), "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"), "words_per_line": per("n_words", "n_lines"),
        "digit_share": per("digits", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, STATISTICS.index(self.statistic)]
        return column > self.threshold if self.above else column <= self.threshold

    def expression(self, columns: dict[str, Column]) -> Column:
        c = columns[self.statistic]
        return c > self.threshold if self.above else c <= self.threshold


def _candidates(values: np.ndarray) -> list[Condition]:
    out = []
    for j, name in enumerate(STATISTICS):
        distinct = np.unique(values[:, j])
        if len(distinct) > 1:
            middles = (distinct[1:] + distinct[:-1]) / 2
            at = np.unique(np.linspace(0, len(middles) - 1, THRESHOLDS).astype(int))
            out += [Condition(name, above, float(middles[i])) for i in at for above in (True, False)]
    return out


def _grow(values: np.ndarray, bad: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and not bad[inside].all():
        v, b = values[inside], bad[inside]
        before = np.log2(max(b.mean(), 1e-9))
        best, gain = None, 1e-9
        for c in _candidates(v):
            hit = c.holds(v)
            p, n = int(b[hit].sum()), int(hit.sum())
            if p and p * (np.log2(p / n) - before) > gain:
                best, gain = c, p * (np.log2(p / n) - before)
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(values)
    return rule


def _covers(rule: list[Condition], values: np.ndarray) -> np.ndarray:
    hit = np.ones(len(values), bool)
    for c in rule:
        hit &= c.holds(values)
    return hit


def _prune(rule: list[Condition], values: np.ndarray, bad: np.ndarray) -> list[Condition]:
    def worth(r: list[Condition]) -> float:
        hit = _covers(r, values)
        p = int(bad[hit].sum())
        return (2 * p - int(hit.sum())) / max(1, int(hit.sum()))

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(values: np.ndarray, bad: np.ndarray) -> list[list[Condition]]:
    """Ordered rules that reject. Every third row prunes, the others grow; the order of the rows decides which."""
    aside = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES and bad[left & ~aside].sum() >= LEAST_COVERED:
        rule = _prune(_grow(values[left & ~aside], bad[left & ~aside]), values[left & aside], bad[left & aside])
        hit = _covers(rule, values) & left
        if not rule or hit.sum() < LEAST_COVERED or min(
                bad[hit & ~aside].mean() if (hit & ~aside).any() else 0, bad[hit & aside].mean() if (hit & aside).any() else 0) < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules from the labelled documents that pass the base rule; ``labels`` has doc_id and quality (0: bad)."""
    chosen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # at most SAMPLE pairs of numbers: safe to broadcast
    few = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    columns = statistics()
    rows = base_statistics(few).where(~base_failed()).select("doc_id", *(columns[s].alias(s) for s in STATISTICS))
    found = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    values = np.array([[r[s] for s in STATISTICS] for r in found], float).reshape(-1, len(STATISTICS))
    return learn(values, np.array([r["quality"] == 0 for r in found], bool))


def verdict(rules: list[list[Condition]]) -> Column:
    """False where a rule of the list fires, in order, else true."""
    columns, case = statistics(), None
    for rule in rules:
        all_hold = rule[0].expression(columns)
        for c in rule[1:]:
            all_hold = all_hold & c.expression(columns)
        case = F.when(all_hold, False) if case is None else case.when(all_hold, False)
    return F.lit(True) if case is None else case.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, the BASE columns, base_failed, kept."""
    rules = learn_rules(docs, labels, sample)
    return base_statistics(docs).select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and no others."""
    rules = learn_rules(docs, labels, sample)
    rows = base_statistics(docs, F.struct(*docs.columns).alias("__row"))
    return rows.where(~base_failed() & verdict(rules)).select("__row.*")
