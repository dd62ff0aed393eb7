"""Near-duplicate classes by DartMinHash signatures of five-word shingles.

A text is a weighted set: its shingles, each weighted by how often it occurs. Darts fall on the plane of weight and rank with
density one, placed by hashes of the shingle alone; those that land in the region of an element (its weight times all ranks)
belong to the text. Every dart has one of K coordinates; the earliest dart of each coordinate is the signature. Two texts
agree in a coordinate with the probability of their weighted Jaccard similarity. Ranks are thrown layer by layer, each twice
as wide, until every coordinate has a dart, so a text costs about K ln K darts however long it is.

BANDS bands of ROWS coordinates give buckets; a pair of similarity 0.8 shares none with probability (1 - 0.8^5)^26 < 0.00004.
Candidates are verified on their whole shingle sets (32-bit hashes). Rounds come first: every member of a bucket is compared
with the first and the preceding member, classes merge, and the buckets are gone through again with one member per class and
bucket until nothing new is found. Buckets that still hold several classes then have every member compared with every member
of the other classes: few members pair by pair, many in blocks of bounded size, without a row per pair.

Equal word sequences are one node from the start, so copies cost one row. Classes are connected components of verified links.

Defined results: texts of one to four words have one shingle, all their words; texts without words (null too) are classes of
their own; a class is named by its smallest ``doc_id``; repeated rows share a class; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import slices, small_batches, stored_with, text_of
from flowlens.session import stored

SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 26, 5
K = BANDS * ROWS
#: Upper rank of the first layer of darts; each further layer doubles it.
FIRST_RANK = 1 / 16
#: Bucket members whose order is found in one task; a larger bucket is dealt to several.
TOGETHER = 4000
#: Links that one task can join; more are joined by distributed rounds.
HERE = 50_000
#: Members of a bucket whose pairs are listed; those of a larger bucket are compared in blocks of about BLOCK by BLOCK members.
FEW, BLOCK = 16, 500
#: Shingles of a block that are counted at once.
WIDE = 4096
SPACE = " \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _step(n) -> np.ndarray:
    return np.asarray(n, "u8") * np.uint64(0x9E3779B97F4A7C15)


def cells(text: str, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the unit weights of a text: shingle and number of the occurrence."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().split()
    if not words:
        return np.empty(0, "u8")
    h = np.fromiter(map(xxh3_64_intdigest, words), "u8", len(words))
    width = min(width, len(h))
    total = np.zeros(len(h) - width + 1, "u8")
    for i in range(width):
        total += mix(h[i : len(h) - width + 1 + i] + _step(i + 1))
    s = np.sort(mix(total))
    if len(s) > 1 and (same := s[1:] == s[:-1]).any():
        new = np.flatnonzero(np.r_[True, ~same])
        nth = np.arange(len(s)) - np.repeat(new, np.diff(np.r_[new, len(s)]))
        s = np.where(nth > 0, mix(s + _step(nth)), s)
    return s


def _poisson_table(mean: float) -> np.ndarray:
    """P(count <= n) for n = 0, 1, ... until it is 1."""
    n = np.arange(int(mean + 12 * mean**0.5 + 20))
    return np.cumsum(np.exp(n * log(mean) - mean - np.array([lgamma(i + 1) for i in n])))


_TABLES: dict[float, np.ndarray] = {}


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype("f8") * 2.0**-53


def signatures(sets: list[np.ndarray], k: int = K) -> np.ndarray:
    """One row of k dart hashes per non-empty set."""
    with np.errstate(over="ignore"):
        sizes = np.array([len(s) for s in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        out, empty = np.zeros(len(sets) * k, "u8"), np.ones(len(sets) * k, bool)
        enough = k * (log(k) + 2) / sizes
        layer, low, high = 0, 0.0, FIRST_RANK
        active = np.ones(len(sets), bool)
        while active.any():
            mean = high - low
            if mean not in _TABLES:
                _TABLES[mean] = _poisson_table(mean)
            mine = active[owner] if not active.all() else slice(None)
            cell, doc = every[mine], owner[mine]
            darts = mix(cell + _step(layer + 1000))
            n = np.searchsorted(_TABLES[mean], _uniform(mix(darts)))
            cell_of = np.repeat(np.arange(len(cell)), n)
            nth = np.arange(len(cell_of)) - np.repeat(np.cumsum(n) - n, n)
            dart = mix(darts[cell_of] + _step(nth + 1))
            slot = doc[cell_of] * k + ((dart >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype("i8")
            free = empty[slot]
            dart, slot = dart[free], slot[free]
            latest_first = np.argsort(mix(dart + np.uint64(7)))[::-1]  # by rank inside the layer; the earliest is written last
            out[slot[latest_first]] = dart[latest_first]
            empty[slot] = False
            active = (high < enough) | empty.reshape(-1, k).any(1)
            layer, low, high = layer + 1, high, 2 * high
        return out.reshape(-1, k)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band."""
    with np.errstate(over="ignore"):
        parts = signature.reshape(len(signature), BANDS, ROWS)
        total = np.zeros(parts.shape[:2], "u8")
        for i in range(ROWS):
            total = mix(total + parts[:, :, i] + _step(i + 1))
        return mix(total + _step(np.arange(BANDS) + 1)).view("i8")


def node_of() -> Column:
    """128 bits of the digest of the word sequence, null without words."""
    words = F.regexp_replace(F.btrim(text_of(), F.lit(SPACE)), r"[\x20\x09-\x0D]+", " ")
    return F.when(words != "", F.unhex(F.substring(F.sha2(words, 256), 1, 32)))


def _signed(rows: DataFrame) -> DataFrame:
    """doc_id, node, n_cells and band keys of every document; nulls for a text without words."""

    def run(batches):
        for part, texts in slices(batches):
            sets = [cells(t) for t in texts]
            some = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if some:
                for i, row in zip(some, band_keys(signatures([sets[i] for i in some]))):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "node", "n_cells", "keys"])

    return rows.mapInArrow(run, "doc_id long, node binary, n_cells long, keys array<long>")


def _shingle_sets(rows: DataFrame) -> DataFrame:
    def run(batches):
        for part, texts in slices(batches):
            sets = [np.unique((cells(t) & np.uint64(0xFFFFFFFF)).astype("u4")).view("i4") for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(sets, pa.list_(pa.int32()))], ["node", "cells"])

    return rows.mapInArrow(run, "node binary, cells array<int>")


def _joined(batches):
    """node and label from all the links, which one task reads."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array(list(parent), pa.binary()), pa.array([root(x) for x in parent], pa.binary())], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): every node that occurs in ``edges`` (a, b) with the smallest node it is connected to.

    Up to HERE links are joined by one task. More go by stars by turns: neighbours above a node, then those below it, are tied
    to the smallest neighbour; the tables are stored, so lineage stays short.
    """
    tied, numbers = stored_with(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if numbers["rows"] <= HERE:
        return stored(tied.coalesce(1).mapInArrow(_joined, "node binary, label binary"), "labels")
    before = None
    while True:
        both = tied.union(tied.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        small = joined.select("b", "m").union(joined.select("a", "m")).where("b <> m").distinct().toDF("a", "b")
        tied, state = stored_with(small, "edges", sum=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        if state == before:
            break
        before = state
    return tied.select(F.col("a").alias("node"), F.col("b").alias("label")).union(tied.select("b", "b").distinct())


def _pairs(buckets: DataFrame, label: DataFrame | None) -> DataFrame:
    """(a, b, shared): in every bucket, one member per class, each with the bucket's first and its preceding member."""
    if label is not None:
        buckets = (buckets.join(label, "node", "left").groupBy("key", F.coalesce("label", "node").alias("label"))
                   .agg(F.min(F.struct("node", "n_cells")).alias("x")).select("key", "x.node", "x.n_cells"))
    first = buckets.groupBy("key").agg(F.min(F.struct("node", "n_cells")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = buckets.join(first, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / TOGETHER)))
    by = Window.partitionBy("key", "part").orderBy("node")
    rows = rows.withColumn("prior", F.lag(F.struct("node", "n_cells")).over(by))
    pairs = rows.select(F.explode(F.array("first", "prior")).alias("o"), "node", "n_cells").where(
        (F.col("o.node") < F.col("node"))
        & (F.least("n_cells", F.col("o.n_cells")) >= LEAST * F.greatest("n_cells", F.col("o.n_cells"))))
    return pairs.groupBy(F.col("o.node").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of similarity LEAST or more, judged on the whole sets."""
    joined = pairs.join(sets.toDF("a", "ca"), "a").join(sets.toDF("b", "cb"), "b")
    common = F.size(F.array_intersect("ca", "cb"))
    return joined.where(common >= LEAST * (F.size("ca") + F.size("cb") - common)).select("a", "b")


def _across(block: pa.Table) -> pa.Table:
    """Links of similarity LEAST or more between members of two sides and different classes, enough of them to join the classes."""
    flat = block.column("cells").combine_chunks()
    sizes, every = flat.value_lengths().to_numpy(zero_copy_only=False).astype("i8"), flat.flatten().to_numpy()
    right = block.column("minor").to_numpy()
    of_class = block.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    x, y = np.flatnonzero(~right), np.flatnonzero(right)
    row = np.where(right, np.cumsum(right), np.cumsum(~right)) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, at = np.unique(every, return_inverse=True)
    on_left, on_right = np.zeros(len(values), bool), np.zeros(len(values), bool)
    on_left[at[~right[owner]]] = on_right[at[right[owner]]] = True
    both = on_left & on_right
    some = both[at]
    column, owner = (np.cumsum(both) - 1)[at[some]], owner[some]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(x), len(y)), "f4")
    for start in range(0, int(both.sum()), WIDE):
        cut = slice(*np.searchsorted(column, [start, start + WIDE]))
        has = [np.zeros((n, WIDE), "f4") for n in common.shape]
        for side, here in enumerate((~right[owner[cut]], right[owner[cut]])):
            has[side][row[owner[cut][here]], column[cut][here] - start] = 1
        common += has[0] @ has[1].T
    alike = (common >= LEAST * (sizes[x][:, None] + sizes[y] - common.astype("f8"))) & (of_class[x][:, None] != of_class[y])
    parent, links = list(range(len(sizes))), []

    def root(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    for i, j in zip(*(k.tolist() for k in np.nonzero(alike))):
        if (a := root(of_class[x[i]])) != (b := root(of_class[y[j]])):
            parent[a] = b
            links.append((x[i], y[j]))
    nodes = block.column("node").combine_chunks()
    return pa.table({c: nodes.take(pa.array([link[k] for link in links], pa.int64())) for k, c in enumerate("ab")})


def _rest(buckets: DataFrame, label: DataFrame, tested: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes that the rounds have left untested: of every bucket, all its members against the other classes.

    Nothing is left in a bucket of one class or of two members, nor of three in three classes: the rounds test all their pairs.
    Of two members in different classes one is outside the bucket's largest class, so only such members are copied to blocks.
    """
    rows = buckets.join(label, "node", "left").select("key", "node", "n_cells", F.coalesce("label", "node").alias("label"))
    by_class = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
    still = by_class.groupBy("key").agg(
        F.sum("k").alias("n"), F.count(F.lit(1)).alias("classes"), F.max(F.struct("k", "label")).alias("most")).where(
        "classes > 1 AND n > 2 AND (n > 3 OR classes < 3)")
    still = stored(still.select("key", "n", (F.col("n") - F.col("most.k")).alias("n_minor"), F.col("most.label").alias("largest")), "open")
    rows = stored(rows.join(still, "key"), "open-members")

    few = rows.where(F.col("n") <= FEW)
    a, b = (few.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n_cells", "label")]) for x in "ab")
    pairs = a.join(b, "key").where("node_a < node_b AND label_a <> label_b").where(
        F.least("n_cells_a", "n_cells_b") >= LEAST * F.greatest("n_cells_a", "n_cells_b"))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")

    many = rows.where(F.col("n") > FEW)
    parts, minor_parts = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("n_minor") / BLOCK)
    part = lambda n: F.pmod(F.xxhash64("node"), n)
    blocks = many.select("key", part(parts).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), minor_parts - 1)).alias("against"),
                         "node", "label", F.lit(False).alias("minor"))
    blocks = blocks.union(many.where("label <> largest").select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), part(minor_parts).alias("against"),
        "node", "label", F.lit(True).alias("minor")))
    found = blocks.join(sets, "node").groupBy("key", "part", "against").applyInArrow(_across, "a binary, b binary")
    return _verified(pairs, sets).union(found)


def _classes(docs: DataFrame) -> DataFrame:
    """``near_classes`` with the node of every document."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", node_of().alias("node"), text_of().alias("text"))
    signed = stored(_signed(rows), "signatures")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("n_cells").alias("n_cells"), F.first("keys").alias("keys"))
    nodes = stored(nodes, "nodes")
    exploded = nodes.select("node", "n_cells", F.explode("keys").alias("key"))
    # stored, so that both sides of the join are plain shuffles, which Spark splits where a key is hot
    shared = stored(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared-keys")
    buckets = stored(exploded.join(shared, "key", "left_semi"), "buckets")
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("__id"))
    texts = rows.join(wanted, (rows["node"] == wanted["node"]) & rows["doc_id"].eqNullSafe(wanted["__id"])).select(rows["doc_id"], rows["node"], "text")
    sets = stored(_shingle_sets(texts).groupBy("node").agg(F.first("cells").alias("cells")), "shingles")

    best = _pairs(buckets, None).groupBy("b").agg(F.max(F.struct("shared", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    tested = stored(best, "pairs")
    links = stored(_verified(tested, sets), "links")
    while True:
        label = components(links)
        fresh, numbers = stored_with(_pairs(buckets, label).select("a", "b").join(tested, ["a", "b"], "left_anti"), "pairs")
        if not numbers["rows"]:
            break
        tested = tested.unionByName(fresh)
        found, numbers = stored_with(_verified(fresh, sets), "links")
        if not numbers["rows"]:
            break
        links = links.unionByName(found)
    found, numbers = stored_with(_rest(buckets, label, tested, sets), "links")
    if numbers["rows"]:
        label = components(links.unionByName(found))

    members = nodes.join(label, "node", "left").select("node", "doc_id", "copies", F.coalesce("label", "node").alias("label"))
    classes = members.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_node = members.select("node", "label").join(classes, "label").select("node", "class_id", "class_size")
    out = signed.select("doc_id", "node").join(of_node, "node", "left")
    class_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", "node", class_id.alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
                      F.col("doc_id").eqNullSafe(class_id).alias("kept"))


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size (documents), kept (it names its class)."""
    return _classes(docs).drop("node")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each class, with all their columns; rows repeated whole stay together."""
    dropped = _classes(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("node").alias("__of")).distinct()
    rows = docs.withColumn("__node", node_of())
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__node") == F.col("__of"))
    return rows.join(dropped, same, "left_anti").select(*docs.columns)
