"""Mixing sources to target weights: repetition rates per source, then whole copies and one seeded draw per document.

The size of a document is its number of words. Sources share ``share`` times the words of all documents by weight; none gets
more than ``most`` times its own words, and what it cannot take is shared again by weight among the others, until none is
above. The rate of a source is its target by its words. A document is emitted floor(rate) times, and once more if its own draw
lies below the fraction. The draw is a hash of seed, ``doc_id`` and text, so it does not depend on partitions or reruns.

Sizes are added up inside tasks before the shuffle, so a hot source costs a row a task. Sources may be many: their order,
which the weights follow, comes from a range sort with offsets per partition, and a round of sharing brings two sums to the
driver. Documents meet the rates by a join that Spark broadcasts when the rates are small and splits when a source is hot.

Defined results: a null text has size 0; a null ``source`` is a source of its own, the last in order, and the empty string
another; a source without words has target 0 and its documents are not emitted; a null ``doc_id`` counts as the empty string
in the draw; rows equal in ``doc_id`` and text share their draw; an empty table gives no rows; other columns are ignored by
``drawn`` and kept by ``mix``, which adds ``mix_copy`` in place of a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import text_of
from flowlens.session import stored

#: Weights by place of the source in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix by words of all documents, as numerator and denominator.
SHARE = (3, 2)
MOST = 2
SEED = "mix"

_HEX_DIGITS = 13


def size_of(column: str = "text") -> Column:
    """Words of a text."""
    return F.regexp_count(text_of(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(seed: str = SEED) -> Column:
    """Even number in [0, 1) that belongs to the document."""
    own = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of()))
    digits = F.substring(F.md5(own), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(16**_HEX_DIGITS))


def _weighted(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, weight): weights by place in code-point order, null last; no task holds all sources."""
    ordered = sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    ordered = stored(ordered, "mix-sources")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = ordered.withColumn("inside", inside).join(F.broadcast(offsets), "part")  # a row per shuffle partition
    at = F.pmod(F.col("before") + F.col("inside") - 1, F.lit(len(weights))).cast("int")
    return place.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), at + 1).cast("long").alias("weight"))


def rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) of sources given by (source, source_size)."""
    sources = stored(_weighted(sizes, weights), "mix-weights")
    num, den = share
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = most * F.col("source_size")
    full, left = 0, None
    while True:  # the common level only rises, so a source that is full stays full
        level = None if left is None else (num * total - den * full) / (den * left) if left else float("inf")
        is_full = F.lit(False) if level is None else cap < F.col("weight") * F.lit(level)
        sums = sources.agg(F.sum(F.when(is_full, cap)), F.sum(F.when(~is_full, F.col("weight")))).first()
        found = (sums[0] or 0, sums[1] or 0)
        if found == (full, left) or not found[1]:
            break
        full, left = found
    open_ = F.col("weight") * F.lit(num * total - den * full) / F.lit(den * (left or 1))
    target = F.when(is_full, cap.cast("double")).otherwise(F.least(open_, cap.cast("double")))
    return sources.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def _copies(own_draw: Column) -> Column:
    return (F.floor("rate") + (own_draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long")


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def drawn(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies. Texts are read once."""
    thin = stored(docs.select("doc_id", "source", size_of().alias("size"), draw(seed).alias("draw")), "mix-sizes")
    found = stored(rates(_sizes(thin), weights, share, most).withColumnRenamed("source", "__source"), "mix-rates")
    return thin.join(found, F.col("source").eqNullSafe(F.col("__source"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", _copies(F.col("draw")).alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is drawn, with ``mix_copy`` from 1."""
    sizes = _sizes(docs.select("source", size_of().alias("size")))
    found = rates(sizes, weights, share, most).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    found = stored(found, "mix-rates")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("own"), draw(seed).alias("draw"))
    repeated = rows.join(found, F.col("own").eqNullSafe(F.col("__source"))).withColumnRenamed("__rate", "rate").withColumn(
        "copies", _copies(F.col("draw"))).where("copies > 0")
    return repeated.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "mix_copy"),
                           F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("mix_copy"))


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of every document."""
    return drawn(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
n AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t)), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM n GROUP BY source),
w AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST) AS place FROM w),
l AS (
  SELECT a.source, a.source_size, a.weight, a.total,
         (3 * a.total - 4 * coalesce(sum(CASE WHEN b.place < a.place THEN b.source_size END), 0))
         / (2.0 * sum(CASE WHEN b.place >= a.place THEN b.weight END)) AS level
  FROM o a CROSS JOIN o b GROUP BY a.source, a.source_size, a.weight, a.total),
f AS (
  SELECT *, 2 * source_size < weight * level AS is_full FROM l),
g AS (
  SELECT coalesce(sum(CASE WHEN is_full THEN 2 * source_size END), 0) AS full_size,
         coalesce(sum(CASE WHEN NOT is_full THEN weight END), 1) AS rest FROM f),
r AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
              ELSE least(CAST(weight * (3 * total - 2 * full_size) AS DOUBLE) / CAST(2 * rest AS DOUBLE), CAST(2 * source_size AS DOUBLE)) END AS target
  FROM f CROSS JOIN g),
q AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM r)
SELECT n.doc_id, n.size, q.source_size, q.target,
       CAST((floor(q.rate) + CASE WHEN n.draw < q.rate - floor(q.rate) THEN 1 ELSE 0 END) * n.size AS BIGINT) AS taken
FROM n JOIN q ON n.source IS NOT DISTINCT FROM q.source
"""
