"""Frequent host sets and association rules of every address at once.

A basket is one hour of the day, so an address has at most 24 of them and the baskets of a host fit into one bit mask:
the support of a set is the number of bits its masks have in common.

An address that visits n hosts in every hour has 2^n frequent sets, so sets are kept closed: a closed set is a mask, the hours
common to its hosts, together with all hosts that are visited in those hours. Every frequent set lies in the closed set of its
mask and has its support; nothing is left out and no size is limited. ``frequent_itemsets`` spells the sets out for those who
ask for it.

The closed masks of an address are the intersections of its hosts' masks. Where they are few they are grown mask by mask;
where that would cost more than the lattice of its hours, one pass over the lattice finds them all: for every set of hours the
intersection of the masks that hold it, summed over supersets hour by hour. Either way every closed mask is found once, in one
task per address whose size 24 hours bound, however many hosts there are. Closed masks then meet the hosts' masks in blocks of
bounded size, a pair of blocks a row, so an address with many masks is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.skew import group_pairs, salted_lookup
from flowlens.session import cut_lineage, stored

HOURS = 24
MIN_SUPPORT = 0.5
MIN_CONFIDENCE = 0.6
#: Masks of one block, about; a task compares two blocks at a time.
BLOCK_MASKS = 2048
#: Rows of an Arrow batch that tasks send on.
BATCH = 1 << 16


def basket_masks(visits: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Frequent hosts per address: ``ip, host, mask, need`` (need = smallest frequent count).

    ``visits``: ip, host, hour (0-23), any number of rows.
    """
    bit = F.call_function("shiftleft", F.lit(1), F.col("hour").cast("int"))
    masks = visits.groupBy("ip", "host").agg(F.bit_or(bit).alias("mask"))
    # the hours of an address: one bit mask again, so the pass is pre-aggregated
    hours = masks.groupBy("ip").agg(F.bit_or("mask").alias("all"))
    need = hours.select("ip", F.ceil(F.bit_count("all") * F.lit(min_support)).cast("int").alias("need"))
    return salted_lookup(masks, need, ["ip"], "host", "inner").where(F.bit_count("mask") >= F.col("need"))


def _leading_bits(mask: Column, need: Column) -> Column:
    """Hours of which at least one is common to any two masks that share ``need`` hours.

    A mask of n hours has to give up fewer than ``need`` of them, so its first n - need + 1 hours suffice.
    """
    hours = F.filter(
        F.array(*[F.lit(h) for h in range(HOURS)]),
        lambda h: mask.bitwiseAND(F.call_function("shiftleft", F.lit(1), h)) != 0,
    )
    return F.slice(hours, F.lit(1), F.greatest(F.size(hours) - need + 1, F.lit(1)))


def _grown(masks: np.ndarray, need: int, most: int) -> np.ndarray | None:
    """All intersections of the masks with ``need`` bits, mask by mask; None once that has taken ``most`` steps."""
    found, steps = np.empty(0, "i4"), 0
    for m in masks:
        steps += len(found) + 1
        if steps > most:
            return None
        new = found & m
        found = np.union1d(found, np.append(new[np.bitwise_count(new) >= need], m))
    return found


def _lattice(masks: np.ndarray, need: int, hours: int) -> np.ndarray:
    """The same from the lattice of ``hours`` bits: a set is closed if the masks that hold it have just its bits in common."""
    common = np.full(1 << hours, -1, "i4")  # all bits: no mask holds the set
    common[masks] = masks
    for h in range(hours):
        half = common.reshape(-1, 2, 1 << h)
        half[:, 0] &= half[:, 1]
    every = np.flatnonzero(common == np.arange(1 << hours, dtype="i4")).astype("i4")
    return every[np.bitwise_count(every) >= need]


def closed_masks(masks: np.ndarray, need: int) -> np.ndarray:
    """Intersections of one or more of the masks that keep ``need`` bits or more; only hours in which masks differ matter."""
    masks = np.unique(masks.astype("i4"))
    masks = masks[np.bitwise_count(masks) >= need]
    if not len(masks):
        return masks
    shared = int(np.bitwise_and.reduce(masks))
    differ = int(np.bitwise_or.reduce(masks)) & ~shared
    at = [h for h in range(HOURS) if differ >> h & 1]
    packed = np.zeros(len(masks), "i4")
    for k, h in enumerate(at):
        packed |= (masks >> h & 1) << k
    least = max(0, need - shared.bit_count())
    found = _grown(packed, least, 1 << len(at))
    if found is None:
        found = _lattice(packed, least, len(at))
    out = np.full(len(found), shared, "i4")
    for k, h in enumerate(at):
        out |= (found >> k & 1) << h
    return out


def closed_sets(masks: DataFrame) -> DataFrame:
    """Masks of the closed frequent sets: ``ip, need, mask, freq``; the kinds of masks of an address stream through one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(ip, need, parts):
            found = closed_masks(np.concatenate(parts), need)
            for k in range(0, len(found), BATCH):
                part = found[k : k + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array([ip] * len(part), pa.string()), pa.array([need] * len(part), pa.int32()),
                                                  pa.array(part, pa.int32())], ["ip", "need", "mask"])

        ip, need, parts = None, 0, []
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            needs, kinds = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edge = np.flatnonzero(np.diff(code, prepend=-1)).tolist()
            for begin, end in zip(edge, [*edge[1:], len(code)]):
                here = names.dictionary[int(code[begin])].as_py()
                if here != ip:
                    if parts:
                        yield from sets(ip, need, parts)
                    ip, need, parts = here, int(needs[begin]), []
                parts.append(kinds[begin:end].copy())
        if parts:
            yield from sets(ip, need, parts)

    kinds = masks.where("ip IS NOT NULL").select("ip", "need", F.col("mask").cast("int").alias("mask")).distinct()
    found = kinds.repartition("ip").sortWithinPartitions("ip").mapInArrow(run, "ip string, need int, mask int")
    return stored(found, "closed-sets").withColumn("freq", F.bit_count("mask"))


def _in_blocks(masks: DataFrame, tag: str) -> DataFrame:
    """(ip, need, block, masks): the masks of an address in arrays of about BLOCK_MASKS."""
    number = masks.groupBy("ip").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MASKS).cast("int").alias("blocks"))
    own = salted_lookup(masks, number, ["ip"], "mask", "inner").withColumn("block", F.pmod(F.xxhash64("mask"), F.col("blocks")))
    return own.groupBy("ip", "need", "block").agg(F.collect_list("mask").alias(tag)).drop("block")


def mask_pairs(closed: DataFrame, masks: DataFrame, min_confidence: float = 1.0) -> DataFrame:
    """(ip, mask, other, common): closed masks with the hosts' masks that have ``need`` of their hours and enough of them all."""
    kinds = masks.select("ip", "need", F.col("mask").cast("int").alias("mask")).distinct()
    names = ["ip", "mask", "other", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sets, others = np.array(row["sets"], "i4"), np.array(row["others"], "i4")
                size = np.bitwise_count(sets)[:, None]
                step = max(1, (1 << 22) // len(others))
                for k in range(0, len(sets), step):
                    common = np.bitwise_count(sets[k : k + step, None] & others)
                    at, other = np.nonzero((common >= row["need"]) & (common / size[k : k + step] >= min_confidence))
                    for i in range(0, len(at), BATCH):
                        a, b = at[i : i + BATCH], other[i : i + BATCH]
                        yield pa.RecordBatch.from_arrays([pa.array([row["ip"]] * len(a), pa.string()), pa.array(sets[k + a]), pa.array(others[b]),
                                                          pa.array(common[a, b].astype("i4"))], names)

    pairs = _in_blocks(closed.select("ip", "need", "mask"), "sets").join(_in_blocks(kinds, "others").drop("need"), "ip")
    n = max(closed.sparkSession.sparkContext.defaultParallelism, int(closed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a pair of blocks is a row of bounded size: few of them in a batch
    rows = pairs.select("ip", "need", "sets", "others").repartition(n, F.xxhash64("ip", F.col("sets")[0], F.col("others")[0]))
    return rows.mapInArrow(run, "ip string, mask int, other int, common int")


def set_members(closed: DataFrame, masks: DataFrame) -> DataFrame:
    """Hosts of every closed set, one row each: ``ip, mask, freq, host, own`` (own: the host's hours)."""
    return _named(mask_pairs(closed, masks), masks)


def _named(pairs: DataFrame, masks: DataFrame) -> DataFrame:
    hosts = masks.select("ip", F.col("mask").cast("int").alias("other"), "host")
    inside = pairs.where(F.col("common") == F.bit_count("mask")).join(hosts, ["ip", "other"])
    return inside.select("ip", "mask", F.bit_count("mask").alias("freq"), "host", F.col("other").alias("own"))


def closed_rules(closed: DataFrame, masks: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from a closed set to one host: ``ip, rule (mask of the set), recommend, support, confidence``.

    A rule stands for the rules of every set with that mask. Hosts outside the set follow with the share of its hours they
    have; a host of the set itself follows with confidence 1 if the other hosts alone have the same hours in common.
    """
    pairs = stored(mask_pairs(closed, masks, min_confidence), "mask-pairs")
    hosts = masks.select("ip", F.col("mask").cast("int").alias("other"), F.col("host").alias("recommend"))
    outside = pairs.where(F.col("common") < F.bit_count("mask")).withColumn(
        "confidence", F.col("common") / F.bit_count("mask")).join(hosts, ["ip", "other"])
    members = stored(_named(pairs, masks), "set-members")
    bit = lambda h: F.call_function("shiftleft", F.lit(1), F.lit(h))
    lacking = [F.count_if(F.col("own").bitwiseAND(bit(h)) == 0) for h in range(HOURS)]
    once = sum((F.when(n == 1, bit(h)).otherwise(0) for h, n in enumerate(lacking)), F.lit(0))
    sets = members.groupBy("ip", "mask").agg(once.alias("once"), F.count(F.lit(1)).alias("size"))
    inside = members.join(sets.where("size > 1"), ["ip", "mask"]).where(F.bitwise_not("own").bitwiseAND(F.col("once")) == 0)
    return outside.select("ip", F.col("mask").alias("rule"), "recommend", F.bit_count("mask").alias("support"), "confidence").unionByName(
        inside.select("ip", F.col("mask").alias("rule"), F.col("host").alias("recommend"), F.col("freq").alias("support"),
                      F.lit(1.0).alias("confidence")))


def frequent_pairs(masks: DataFrame) -> DataFrame:
    """Frequent sets of two hosts.

    Hosts with one mask behave alike, so masks (not hosts) are compared: two different masks meet in a leading hour both
    have, and only pairs of masks that are frequent together are expanded to hosts.
    """
    kinds = masks.select("ip", "mask", "need").distinct()
    keyed = kinds.withColumn("h", F.explode(_leading_bits(F.col("mask"), F.col("need"))))
    met = group_pairs(
        keyed.select(F.struct("ip", "h").alias("k"), "mask", "need"), "k", "mask", "need",
        F.bit_count(F.col("mask_l").bitwiseAND(F.col("mask_r"))) >= F.col("need_l"),
    )
    kind_pairs = met.select(
        F.col("k.ip").alias("ip"), F.col("left").alias("mask"), F.col("right").alias("mask2"), F.col("left_value").alias("need")
    ).distinct()
    a = masks.select("ip", "mask", F.col("host").alias("h1"))
    b = masks.select("ip", F.col("mask").alias("mask2"), F.col("host").alias("h2"))
    different = kind_pairs.join(a, ["ip", "mask"]).join(b, ["ip", "mask2"]).select(
        "ip", F.array_sort(F.array("h1", "h2")).alias("items"), F.col("mask").bitwiseAND(F.col("mask2")).alias("mask"), "need"
    )
    # hosts with the same mask are frequent together: every pair of them belongs to the result
    alike = group_pairs(masks.select(F.struct("ip", "mask").alias("k"), "host", "need"), "k", "host", "need").select(
        F.col("k.ip").alias("ip"), F.array("left", "right").alias("items"), F.col("k.mask").alias("mask"),
        F.col("left_value").alias("need"),
    )
    return different.unionByName(alike)


def frequent_itemsets(visits: DataFrame, min_support: float = MIN_SUPPORT, max_size: int | None = None) -> DataFrame:
    """All frequent sets spelled out, or those of up to ``max_size`` hosts: ``ip, items (sorted), size, freq``.

    Sets of size n that agree on all but their last host are joined to sets of size n + 1 until none is left. The answer
    may be exponential in the hosts of an address; ``closed_sets`` says the same in short.
    """
    masks = cut_lineage(basket_masks(visits, min_support))
    singles = masks.select("ip", F.array("host").alias("items"), "mask", "need")
    level = cut_lineage(frequent_pairs(masks)) if max_size is None or max_size > 1 else singles.limit(0)
    levels, size = [singles, level], 2
    while (max_size is None or size < max_size) and not level.isEmpty():
        head = F.struct("ip", F.slice("items", 1, size - 1).alias("head"), "need")
        last = level.select(head.alias("k"), F.element_at("items", -1).alias("x"), "mask")
        common = F.col("mask_l").bitwiseAND(F.col("mask_r"))
        grown = group_pairs(last, "k", "x", "mask", F.bit_count(common) >= F.col("__key_l.need"))
        level = cut_lineage(
            grown.select(
                "k.ip", F.concat("k.head", F.array("left", "right")).alias("items"),
                F.col("left_value").bitwiseAND(F.col("right_value")).alias("mask"), "k.need",
            )
        )
        levels.append(level)
        size += 1
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    return out.select("ip", "items", F.size("items").alias("size"), F.bit_count("mask").alias("freq"))


def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules with one host as consequent: ``ip, rule, recommend, support, confidence``; support counts the antecedent."""
    sets = itemsets.where(F.col("size") > 1)
    split = sets.select("ip", "freq", "items", F.explode("items").alias("recommend"))
    split = split.withColumn("antecedent", F.array_except("items", F.array("recommend")))
    base = itemsets.select("ip", F.col("items").alias("antecedent"), F.col("freq").alias("support"))
    rules = split.join(base, ["ip", "antecedent"]).withColumn("confidence", F.col("freq") / F.col("support"))
    return rules.where(F.col("confidence") >= min_confidence).select(
        "ip", F.array_join("antecedent", "#").alias("rule"), "recommend", "support", "confidence"
    )
