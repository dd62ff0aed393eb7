"""Exact deduplication by skew-safe combining, DataFrame operations only.

Texts are equal when identical after every run of white space became one space. Three stages, each grouping by the whole text
beside its digest, so two texts with one digest never merge: equal rows meet inside each task (the map side of the
aggregation), then inside salted digest groups, then the salt winners globally. A group of any size reaches a task as at most
one row per salt. The rows are then looked up by digest in a table without texts; the join is one that Spark splits when a
digest is hot. Should two texts share a digest, their rows are looked up by content instead.

Defined results: null text counts as empty; a null ``doc_id`` stays only if its whole group has none; rows equal in ``doc_id``
and text are one group and the first of them stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import text_of
from flowlens.session import stored

#: Pieces into which a digest group may fall before its winners meet.
SALTS = 32


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text of ``rows`` (doc_id, digest, text): keep_id, group_size; partitioned by digest."""
    salted = rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"), "text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return salted.repartition("digest").groupBy("digest", "text").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_groups(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` maps the text column to a key; the result does not depend on it.
    """
    rows = docs.select("doc_id", normalised().alias("text")).withColumn("digest", digest(F.col("text")))
    best = winners(rows, salts)
    by_digest = stored(
        best.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.min("keep_id").alias("keep_id"),
                                   F.sum("group_size").alias("group_size")), "exact-groups")
    shared = by_digest.where("variants > 1")
    thin = rows.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256")) if digest is not sha256 else rows.select(
        "doc_id", "digest", F.col("digest").alias("text_sha256"))
    numbered = thin.withColumn("copy", _copy("digest", "text_sha256"))
    found = numbered.join(by_digest.where("variants = 1").drop("variants"), "digest")
    if not shared.isEmpty():
        texts = rows.join(shared.select("digest"), "digest", "left_semi").withColumn("copy", _copy("digest", "text"))
        groups = best.join(shared.select("digest"), "digest", "left_semi")
        found = found.select("doc_id", "text_sha256", "copy", "keep_id", "group_size").unionByName(
            texts.join(groups, ["digest", "text"]).select(
                "doc_id", sha256(F.col("text")).alias("text_sha256"), "copy", "keep_id", "group_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _copy(*content: str) -> Column:
    """Number of a row among the rows with its ``doc_id`` and content: 1 but for rows that are repeated whole."""
    return F.row_number().over(Window.partitionBy("doc_id", *content).orderBy("doc_id"))


def keep_first(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; same rules as ``exact_groups``.

    Only the short list of rows to drop is joined with the texts. Of rows equal in ``doc_id`` and text one stays, even if their
    other columns differ.
    """
    groups = stored(exact_groups(docs, salts).select(F.col("doc_id").alias("__id"), "keep_id", "kept", F.col("text_sha256").alias("__hash")),
                    "exact-verdicts")
    later = ~F.col("kept")
    first_id = F.col("__id").eqNullSafe(F.col("keep_id"))
    rows = docs.withColumn("__sha", sha256(normalised()))
    if not groups.where(later & first_id).isEmpty():
        rows = rows.dropDuplicates(["doc_id", "__sha"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__hash"))
    return rows.join(groups.where(later & ~first_id).select("__id", "__hash"), same, "left_anti").select(*docs.columns)


ORACLE = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
