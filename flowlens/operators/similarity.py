"""Exact cosine similarity of sparse rows, built from (member, key, value) entries.

Entries are aggregates that every step reads again, so they are written once to the shared folder instead of being
computed from the logs for every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.skew import group_pairs, salted_lookup
from flowlens.session import stored


def _unit_entries(entries: DataFrame, member: str, key: str, value: str) -> DataFrame:
    """Entries divided by the length of their member's vector."""
    norms = entries.groupBy(member).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("__norm"))
    return salted_lookup(entries, norms, [member], key, "inner").select(
        F.col(member).alias("m"), F.col(key).alias("k"), (F.col(value) / F.col("__norm")).alias("v")
    )


def cosine_pairs(entries: DataFrame, member: str, key: str, value: str) -> DataFrame:
    """(left, right, sim) for every two members that share a key, left < right.

    The result holds one row per pair that shares a key, so the work per key is the size of its part of the answer;
    products are summed before the shuffle and hot keys are cut into blocks.
    """
    unit = stored(_unit_entries(stored(entries, "entries"), member, key, value), "unit")
    met = group_pairs(unit, "k", "m", "v")
    return met.groupBy("left", "right").agg(F.sum(F.col("left_value") * F.col("right_value")).alias("sim"))


def cosine_pairs_above(entries: DataFrame, member: str, key: str, value: str, threshold: float) -> DataFrame:
    """Pairs with similarity >= threshold, without visiting the pairs of the busiest keys. Exact.

    Keys are ordered by popularity classes (powers of two), the most popular first. Each member leaves out its leading
    classes as long as their part of the unit vector is shorter than the threshold. Take a pair and the member that left out
    more: if the two share no key outside that part, every shared key lies in it, so their product is below the threshold.
    Candidates therefore meet in a key both have kept.

    The pass over the index of kept keys already adds up the product over the classes that both have kept. What is missing
    is the product over the rest of the classes, at most the sum over them of the two lengths multiplied. Pairs that cannot
    reach the threshold with it are dropped, and for the others only the keys that the one member left out are looked up in
    the other; no product is taken twice.
    """
    unit = _unit_entries(stored(entries, "entries"), member, key, value)
    popularity = unit.groupBy("k").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("c"))
    classed = stored(salted_lookup(unit, popularity, ["k"], "m", "inner"), "classed")
    # a few dozen classes per member: the running length needs only one row per class
    per_class = classed.groupBy("m", "c").agg(F.sum(F.col("v") * F.col("v")).alias("s"))
    running = F.sum("s").over(Window.partitionBy("m").orderBy(F.desc("c")))
    slack = threshold * threshold * (1 - 1e-9)
    # one row per member: its most popular class that is kept, and popularity class -> length of the vector inside it
    members = per_class.withColumn("r", running).groupBy("m").agg(
        F.max(F.when(F.col("r") >= slack, F.col("c"))).alias("cut"),
        F.map_from_entries(F.collect_list(F.struct("c", F.sqrt("s")))).alias("by_class"))
    members = stored(members.where("cut IS NOT NULL"), "members")
    cut = salted_lookup(classed, members.select("m", "cut"), ["m"], "k", "inner")
    kept = stored(cut.where("c <= cut").select("m", "k", "v"), "kept")
    met = group_pairs(kept, "k", "m", "v").groupBy("left", "right").agg(F.sum(F.col("left_value") * F.col("right_value")).alias("part"))
    left = members.select(F.col("m").alias("left"), F.col("cut").alias("left_cut"), F.col("by_class").alias("l"))
    right = members.select(F.col("m").alias("right"), F.col("cut").alias("right_cut"), F.col("by_class").alias("r"))
    rest = F.aggregate(
        F.map_entries("l"), F.lit(0.0),
        lambda s, e: s + F.when(e["key"] > F.least("left_cut", "right_cut"), e["value"] * F.coalesce(F.try_element_at("r", e["key"]), F.lit(0.0))).otherwise(0.0))
    near = salted_lookup(salted_lookup(met, left, ["left"], "right", "inner"), right, ["right"], "left", "inner")
    more = F.col("left_cut") <= F.col("right_cut")
    near = near.withColumn("rest", rest).where(F.col("part") + F.col("rest") >= threshold * (1 - 1e-9)).select(
        "left", "right", "part", "rest", F.when(more, F.col("left")).otherwise(F.col("right")).alias("m"),
        F.when(more, F.col("right")).otherwise(F.col("left")).alias("other"))
    near = stored(near, "near-pairs")
    left_out = cut.where("c > cut").select("m", "k", F.col("v").alias("mv"))
    others = classed.select(F.col("m").alias("other"), "k", F.col("v").alias("ov"))
    product = near.where("rest > 0").select("left", "right", "m", "other").join(left_out, "m").join(others, ["other", "k"])
    sims = near.select("left", "right", "part").unionByName(product.select("left", "right", (F.col("mv") * F.col("ov")).alias("part")))
    return sims.groupBy("left", "right").agg(F.sum("part").alias("sim")).where(F.col("sim") >= threshold - 1e-12)


def item_similarity(ratings: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Hosts visited alike: cosine over the addresses, published from the threshold on."""
    return cosine_pairs_above(ratings, "host", "ip", "count", threshold)


def user_similarity(ratings: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Addresses that behave alike: cosine over the hosts, three decimals, published from the threshold on.

    Every two addresses with a common host have some similarity, so the threshold is part of the question.
    """
    return cosine_pairs_above(ratings, "ip", "host", "count", threshold).withColumn("sim", F.round("sim", 3))
