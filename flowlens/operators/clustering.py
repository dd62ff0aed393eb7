"""K-means jobs: whole-table models, clusters inside many groups at once, outlier clusters and scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.scaling import min_max_scale, with_table_stats
from flowlens.operators.skew import hot_keys, label_lookup, row_salt, salted_lookup, with_salts
from flowlens.session import cut_lineage, for_many_passes, stored

SEED = 42


def guarded_k(n: int, k: int) -> int:
    """Cluster count for n rows: 1 for up to two rows, n - 1 for up to k rows, else k."""
    if n <= 2:
        return 1
    return n - 1 if n <= k else k


def assemble(df: DataFrame, columns: list[str], out: str = "vector") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error").transform(df)


def kmeans_fit(vectors: DataFrame, k: int, vector: str = "vector", seed: int = SEED, max_iter: int = 20) -> KMeansModel:
    """K-means with the guarded k; the input should be persisted by the caller."""
    n = vectors.limit(k + 1).count()  # only whether there are more than k rows matters
    return KMeans(k=guarded_k(n, k), featuresCol=vector, predictionCol="label", seed=seed, maxIter=max_iter).fit(vectors)


def centers_frame(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """Centers as (label, center array); k rows."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "label int, center array<double>")


def assign(model: KMeansModel, vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """Label and distance to the assigned center."""
    centers = centers_frame(vectors.sparkSession, model)
    labelled = model.transform(vectors).withColumn("__v", vector_to_array(vector))
    joined = label_lookup(labelled, centers, how="inner", few=True)
    return joined.withColumn("distance", array_distance(F.col("__v"), F.col("center"))).drop("__v")


def array_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def vector_centers(points: DataFrame, vector: str = "v", label: str = "label") -> DataFrame:
    """Mean vector of every label, over all dimensions."""
    mean = Summarizer.mean(array_to_vector(vector))
    return points.groupBy(label).agg(mean.alias("__m")).select(label, vector_to_array("__m").alias("center"))


def _first_centers(vectors: DataFrame, most: int, vector: str, seed: int) -> np.ndarray:
    """Up to ``most`` centers in an order in which every prefix is spread out: the first is the largest cluster's, the next
    one always the farthest from those before. Found by the library's parallel seeding over all rows."""
    model = KMeans(k=most, featuresCol=vector, predictionCol="label", seed=seed, maxIter=1).fit(vectors)
    centers, sizes = np.array(model.clusterCenters()), model.summary.clusterSizes
    order = [int(np.argmax(sizes[: len(centers)]))]
    far = ((centers - centers[order[0]]) ** 2).sum(1)
    while len(order) < len(centers):
        order.append(int(np.argmax(far)))
        far = np.minimum(far, ((centers - centers[order[-1]]) ** 2).sum(1))
        far[order] = -1.0
    return centers[order]


def _batches_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _nearest(points: np.ndarray, centers: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Label and squared distance of every point for every set of centers, from one product with all centers."""
    every = np.concatenate(centers)
    square = (every * every).sum(1) - 2 * points @ every.T
    own, at = (points * points).sum(1), 0
    for c in centers:
        part = square[:, at : at + len(c)]
        label = part.argmin(1)
        yield label, np.maximum(own + part[np.arange(len(points)), label], 0.0)
        at += len(c)


def _moments(points: DataFrame, centers: list[np.ndarray]) -> list[np.ndarray]:
    """For every set of centers a row per label: members, squared distances to the center, squared lengths, sums.

    One scan for all sets; a task sends on a row per label, and so many reach the driver.
    """
    width = centers[0].shape[1]
    columns = ["n", "cost", "square", *(f"s{i}" for i in range(width))]

    def run(batches):
        total = [np.zeros((len(c), 3 + width)) for c in centers]
        for x in _batches_of(batches, width):
            own = (x * x).sum(1)
            for table, (label, square) in zip(total, _nearest(x, centers)):
                for k, values in enumerate((None, square, own, *x.T)):
                    table[:, k] += np.bincount(label, values, len(table))
        rows = np.concatenate(total)
        which = np.repeat(np.arange(len(centers)), [len(c) for c in centers])
        label = np.concatenate([np.arange(len(c)) for c in centers])
        yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(label), *(pa.array(rows[:, i]) for i in range(3 + width))],
                                         ["which", "label", *columns])

    schema = "which long, label long, " + ", ".join(f"{c} double" for c in columns)
    out = [np.zeros((len(c), 3 + width)) for c in centers]
    for row in points.mapInArrow(run, schema).groupBy("which", "label").agg(*[F.sum(c) for c in columns]).collect():
        out[row[0]][row[1]] = row[2:]
    return out


def kmeans_sweep(vectors: DataFrame, ks: list[int], vector: str = "vector", seed: int = SEED, max_iter: int = 10,
                 tol: float = 1e-4) -> list[tuple[np.ndarray, np.ndarray]]:
    """(centers, moments) of k-means for every k, all of them in one scan of the rows a round.

    Every k starts from as many of the same spread-out centers. The moments belong to the centers given with them.
    """
    first = _first_centers(vectors, max(ks), vector, seed)
    points = vectors.select(vector_to_array(vector).alias("x"))
    centers = [first[:k].copy() for k in ks]
    found = _moments(points, centers)
    for _ in range(max_iter):
        moved = 0.0
        for c, m in zip(centers, found):
            some = m[:, 0] > 0
            new = m[some, 3:] / m[some, :1]
            moved = max(moved, float(((new - c[some]) ** 2).sum(1).max()))
            c[some] = new
        if moved == 0.0:
            break
        found = _moments(points, centers)
        if moved <= tol * tol:
            break
    return list(zip(centers, found))


def elbow_k(vectors: DataFrame, vector: str = "vector", largest: int = 20, seed: int = SEED) -> int:
    """First k from 2 upward whose successor raises the cost; 2 when the cost falls all the way.

    All k are fitted together. No k above the number of rows less one is tried.
    """
    n = vectors.limit(largest + 1).count()
    if n < 2:
        return 2
    ks = list(range(2, max(2, min(largest, n - 1)) + 1))
    costs = [float(m[:, 1].sum()) for _, m in kmeans_sweep(vectors, ks, vector, seed)]
    for k, before, now in zip(ks, costs, costs[1:]):
        if now > before:
            return k
    return 2


def silhouette_by_k(vectors: DataFrame, ks: list[int], vector: str = "vector", seed: int = SEED) -> DataFrame:
    """Silhouette of every k (squared Euclidean distance); the best one is the largest.

    The mean squared distance of a row to a cluster follows from the cluster's size, sum and squared lengths, so one scan
    after the fits gives the silhouettes of all k.
    """
    fits = kmeans_sweep(vectors, ks, vector, seed, max_iter=20)
    centers, moments = [c for c, _ in fits], [m for _, m in fits]
    width = centers[0].shape[1]

    def run(batches):
        total, n = np.zeros(len(centers)), 0
        for x in _batches_of(batches, width):
            own, row = (x * x).sum(1), np.arange(len(x))
            n += len(x)
            for k, ((label, _), m) in enumerate(zip(_nearest(x, centers), moments)):
                size = np.maximum(m[:, 0], 1)
                away = own[:, None] + m[:, 2] / size - 2 * x @ (m[:, 3:] / size[:, None]).T
                away[:, m[:, 0] == 0] = np.inf
                inside = away[row, label] * m[label, 0] / np.maximum(m[label, 0] - 1, 1)
                away[row, label] = np.inf
                other = away.min(1)
                best = np.maximum(inside, other)
                value = np.where((m[label, 0] > 1) & (best > 0) & np.isfinite(other), (other - inside) / np.where(best > 0, best, 1), 0.0)
                total[k] += value.sum()
        yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(total), pa.array([n] * len(ks), pa.int64())], ["k", "total", "n"])

    points = vectors.select(vector_to_array(vector).alias("x"))
    return points.mapInArrow(run, "k int, total double, n long").groupBy("k").agg((F.sum("total") / F.sum("n")).alias("silhouette"))


def mark_small_clusters(
    points: DataFrame, smaller_than: int = 2, outlier: str = "other", drop_distance: bool = False, few: bool = False
) -> DataFrame:
    """Members of clusters below a size get the outlier label, and distance -1 if asked. ``few``: the labels are a model's."""
    sizes = points.groupBy("label").agg(F.count(F.lit(1)).alias("cluster_size"))
    small = sizes.where(F.col("cluster_size") < smaller_than).select("label", F.lit(True).alias("__small"))
    joined = label_lookup(points, small, few=few)
    lone = F.col("__small").isNotNull()
    out = joined.withColumn("label", F.when(lone, outlier).otherwise(F.col("label").cast("string")))
    if drop_distance:
        out = out.withColumn("distance", F.when(lone, F.lit(-1.0)).otherwise(F.col("distance")))
    return out.drop("__small")


def outlier_score(points: DataFrame, tag: str = "", few: bool = False) -> DataFrame:
    """(scaled distance)^2 + (1 - scaled cluster size)^2 from ``label`` and ``distance``.

    The distance is scaled inside its own cluster from 0 (from the smallest distance if there is one cluster only), the
    size over all rows; a constant column scales to 0.5. ``few``: the labels are a model's.
    """
    per = points.groupBy("label").agg(
        F.count(F.lit(1)).alias("__n"), F.min("distance").alias("__d0"), F.max("distance").alias("__d1")
    )
    per = with_table_stats(per, "__e", k=F.count(F.lit(1)), lo=F.min("__n"), hi=F.max("__n"))
    joined = label_lookup(points, per, how="inner", few=few)
    low = F.when(F.col("__e.k") == 1, F.col("__d0")).otherwise(F.lit(0.0))
    d = F.when(F.col("__d1") == low, F.lit(0.5)).otherwise((F.col("distance") - low) / (F.col("__d1") - low))
    lo, hi = F.col("__e.lo"), F.col("__e.hi")
    size = F.when(hi == lo, F.lit(0.5)).otherwise((F.col("__n") - lo) / (hi - lo))
    return joined.withColumns(
        {f"num{tag}": F.col("__n"), f"unusual{tag}": d * d + (1 - size) * (1 - size)}
    ).drop("__n", "__d0", "__d1", "__e")


def _triple_vectors(sessions: DataFrame, features: list[str]) -> DataFrame:
    return assemble(min_max_scale(sessions, tuple(features)), [f + "_scl" for f in features])


def triple_model(sessions: DataFrame, features: list[str], key: list[str], k: int | None = None) -> KMeansModel:
    """Cluster model of scaled features; k by the elbow rule unless given. ``key`` tells the rows apart."""
    vectors = for_many_passes(_triple_vectors(sessions, features).select(*key, "vector"), *key)
    best = k or elbow_k(vectors)
    model = KMeans(k=best, featuresCol="vector", predictionCol="label", seed=SEED, maxIter=10).fit(vectors)
    vectors.unpersist()
    return model


def triple_scores(sessions: DataFrame, features: list[str], model: KMeansModel, tag: str) -> DataFrame:
    """Rows with the size of their cluster and their outlier score, as ``num<tag>`` and ``unusual<tag>``."""
    scored = outlier_score(assign(model, _triple_vectors(sessions, features)), tag, few=True)
    return scored.select(*sessions.columns, f"num{tag}", f"unusual{tag}")


def grouped_kmeans(
    points: DataFrame, group: list[str], row_key: str, features: list[str], k: int, weight: str | None = None,
    max_iter: int = 100, tol: float = 1e-4, allowed: Callable[[Column], Column] | None = None, scaled: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """K-means inside every group at once, with ``label``, ``cluster_size`` (points) and ``distance`` per point.

    A round is one lookup of the group's k centers and one pre-aggregated mean per (group, label), so a group of any
    size is spread over all tasks and the number of Spark jobs depends on the rounds, not on the groups. The first
    centers are found by farthest-first search from the row with the smallest key, so runs repeat. A group of n distinct
    rows uses at most n centers, and no more than ``allowed`` gives for its weight. Rounds go on until no center moves by
    more than ``tol``, ``max_iter`` of them at most. ``scaled``: the features are min-max scaled inside every group
    (as ``grouped_min_max`` does); ``only``: the groups to cluster, one row each, others have no rows in the result.

    The points are shuffled once. Ends of the features, centers and sizes belong to a group and come to its points.
    """
    dims, types = range(len(features)), dict(points.dtypes)
    # a feature that is a double already is carried once
    carried = {f: F.col(f"__v{j}").alias(f) for j, f in enumerate(features) if types[f] == "double" and f not in (*group, row_key, weight)}
    hot = hot_keys(points, group)
    rows = points
    if only is not None:  # rows of the other hot groups stay where they are, those of cold groups find no center
        hot = cut_lineage(hot)
        names = [f"__h_{c}" for c in group]
        other = hot.join(only.select(*group).toDF(*names), names, "left_anti").select(*names)
        rows = rows.join(F.broadcast(other), reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group, names)]), "left_anti")
    base = rows.select(
        *[c for c in points.columns if c not in carried], *[F.col(f).cast("double").alias(f"__v{j}") for j, f in enumerate(features)],
        (F.col(weight) if weight else F.lit(1)).alias("__w"),
    )
    base = with_salts(base, hot, group).withColumn("__salt", row_salt(row_key, F.col("__salts")))
    # Partitioned once by (group, salt): a round moves the copied centers to the points, never the points.
    base = for_many_passes(base, *group, "__salt", ordered=True)
    ends = [F.array(*[end(f"__v{j}") for j in dims]).alias(n) for end, n in ((F.min, "__lo"), (F.max, "__hi"))] if scaled else []
    frame = ["__salts", *(["__lo", "__hi"] if scaled else [])]  # what a group keeps beside its centers
    vector = F.array(*[F.col(f"__f{j}") for j in dims])

    def placed(df: DataFrame) -> DataFrame:
        """Points beside the frame of their group, with the features that are clustered."""

        def value(j: int) -> Column:
            v, lo, hi = F.col(f"__v{j}"), F.col("__lo")[j], F.col("__hi")[j]
            return F.when(hi == lo, F.lit(0.5)).otherwise((v - lo) / (hi - lo))

        return df.withColumns({f"__f{j}": value(j) if scaled else F.col(f"__v{j}") for j in dims})

    def at_points(per_group: DataFrame) -> DataFrame:
        copies = per_group.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
        return placed(base.drop("__salts").join(copies, [*group, "__salt"]))

    def square(i: int) -> Column:
        """Squared distance to center i; infinite where the group has fewer centers. Plain arithmetic, so it compiles."""
        center = F.get(F.col("__c"), F.lit(i))
        total = F.lit(0.0)
        for j in dims:
            gap = F.col(f"__f{j}") - center[j]
            total = total + gap * gap
        return F.coalesce(total, F.lit(float("inf")))

    def to_points(centers: DataFrame, n: int) -> DataFrame:
        near = at_points(centers).withColumns({f"__d{i}": square(i) for i in range(n)})
        ds = [F.col(f"__d{i}") for i in range(n)]
        least = F.least(*ds) if n > 1 else ds[0]
        label = F.lit(n - 1)
        for i in reversed(range(n - 1)):
            label = F.when(ds[i] == least, i).otherwise(label)
        return near.withColumns({"__d": least, "__l": label})

    most = F.lit(k) if allowed is None else allowed(F.sum("__w"))
    raw = F.array(*[F.col(f"__v{j}") for j in dims])
    first = base.groupBy(*group).agg(F.min_by(raw, F.col(row_key)).alias("__v"), most.cast("int").alias("__most"), F.max("__salts").alias("__salts"), *ends)
    if only is not None:
        first = first.join(only.select(*group), group, "left_semi")
    first = placed(first.select("*", *[F.col("__v")[j].alias(f"__v{j}") for j in dims]))
    centers = first.select(*group, "__most", *frame, F.array(vector).alias("__c"))
    for n in range(1, k):
        far = to_points(centers, n).groupBy(*group).agg(F.max(F.struct(F.col("__d").alias("d"), vector.alias("v"))).alias("__far"))
        more = (F.col("__far.d") > 0) & (F.size("__c") < F.col("__most"))
        grown = F.when(more, F.concat("__c", F.array("__far.v"))).otherwise(F.col("__c"))
        centers = cut_lineage(centers.join(far, group).select(*group, "__most", *frame, grown.alias("__c")))
    centers = centers.drop("__most")

    means = F.array(*[F.sum(F.col(f"__f{j}") * F.col("__w")) / F.sum("__w") for j in dims])
    for _ in range(max_iter):
        moved = (
            to_points(centers, k).groupBy(*group, F.col("__l").alias("l")).agg(means.alias("c"))
            .groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("l", "c"))).alias("__m"))  # at most k rows
        )
        # a center that lost all its points stays where it was
        updated = F.transform(F.col("__c"), lambda c, i: F.coalesce(F.try_element_at(F.col("__m"), i), c))
        shift = F.array_max(F.zip_with(updated, F.col("__c"), array_distance))
        step = cut_lineage(centers.join(moved, group).select(*group, *frame, updated.alias("__u"), shift.alias("__s")))
        centers = step.select(*group, *frame, F.col("__u").alias("__c"))
        if (step.agg(F.max("__s")).first()[0] or 0.0) <= tol:
            break
    sizes = (
        to_points(centers, k).groupBy(*group, F.col("__l").alias("l")).agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("l", "n"))).alias("__n"))  # at most k rows
    )
    near = to_points(centers.join(sizes, group), k)
    found = near.select(*[carried.get(c, F.col(c)) for c in points.columns], F.col("__l").alias("label"),
                        F.element_at("__n", F.col("__l")).alias("cluster_size"), F.sqrt("__d").alias("distance"))
    found = stored(found, "grouped-kmeans")
    base.unpersist()
    return found


def grouped_min_max(
    points: DataFrame, group: list[str], row_key: str, features: list[str], suffix: str = "_scl"
) -> DataFrame:
    """Min-max scaling inside every group; 0.5 for a constant feature."""
    ends = points.groupBy(*group).agg(
        *[F.min(f).alias(f"__{f}_lo") for f in features], *[F.max(f).alias(f"__{f}_hi") for f in features]
    )
    joined = salted_lookup(points, ends, group, row_key, "inner")

    def scaled(f: str) -> Column:
        lo, hi = F.col(f"__{f}_lo"), F.col(f"__{f}_hi")
        return F.when(hi == lo, F.lit(0.5)).otherwise((F.col(f) - lo) / (hi - lo))

    return joined.select(*points.columns, *[scaled(f).alias(f + suffix) for f in features])
