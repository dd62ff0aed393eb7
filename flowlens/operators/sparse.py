"""K-means of sparse rows in long form: entries (member, key, value), centers (key, one column per label).

Neither rows nor centers are ever vectors over all keys, so the number of keys has no limit. The squared distance of a member
to a center is |x|^2 + |c|^2 - 2 sum(x c): a join on the key, and one sum per label and member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.clustering import guarded_k
from flowlens.operators.skew import salted_lookup
from flowlens.session import cut_lineage, stored


def _nearest(entries: DataFrame, norms: DataFrame, centers: DataFrame, n: int) -> DataFrame:
    """(m, xx, d, label): squared distance to the nearest of ``n`` centers; of equal ones the first."""
    c = [F.coalesce(f"c{i}", F.lit(0.0)) for i in range(n)]
    squares = centers.agg(F.struct(*[F.coalesce(F.sum(x * x), F.lit(0.0)).alias(f"q{i}") for i, x in enumerate(c)])).scalar()
    products = salted_lookup(entries, centers, ["k"], "m", "inner").groupBy("m").agg(*[F.sum(F.col("v") * x).alias(f"p{i}") for i, x in enumerate(c)])
    joined = norms.join(products, "m", "left").withColumn("__q", squares)

    def square(i: int) -> Column:
        return F.greatest(F.col("xx") + F.col(f"__q.q{i}") - 2 * F.coalesce(f"p{i}", F.lit(0.0)), F.lit(0.0))

    best = F.array_min(F.array(*[F.struct(square(i).alias("d"), F.lit(i).alias("label")) for i in range(n)]))
    return joined.select("m", "xx", best.alias("b")).select("m", "xx", "b.d", "b.label")


def _means(entries: DataFrame, labelled: DataFrame, n: int) -> DataFrame:
    """Centers (k, c0 ... c<n-1>) of the labelled members."""
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))  # at most n rows
    sums = salted_lookup(entries, labelled.select("m", "label"), ["m"], "k", "inner").groupBy("k", "label").agg(F.sum("v").alias("s"))
    means = sums.join(sizes, "label").withColumn("c", F.col("s") / F.col("n"))
    return means.groupBy("k").agg(*[F.sum(F.when(F.col("label") == i, F.col("c"))).alias(f"c{i}") for i in range(n)])


def sparse_kmeans(entries: DataFrame, member: str, key: str, value: str, k: int, max_iter: int = 20, tol: float = 1e-6) -> DataFrame:
    """Label and distance to its center of every member: ``member, label, distance``.

    ``entries`` has one row per member and key. The first centers are found by farthest-first search from the smallest member,
    so runs repeat; a label that loses its members goes. Rounds end when the cost falls by less than ``tol`` of itself.
    """
    rows = stored(entries.select(F.col(member).alias("m"), F.col(key).alias("k"), F.col(value).cast("double").alias("v")), "entries")
    norms = stored(rows.groupBy("m").agg(F.sum(F.col("v") * F.col("v")).alias("xx")), "norms")
    k = guarded_k(norms.limit(k + 1).count(), k)

    def of(name: str, i: int) -> DataFrame:
        picked = norms.agg(F.min("m").alias("m")) if i == 0 else far
        return rows.join(F.broadcast(picked.select("m")), "m").select("k", F.col("v").alias(name))  # one member

    centers = cut_lineage(of("c0", 0))
    for n in range(1, k):
        far = _nearest(rows, norms, centers, n).agg(F.max(F.struct("d", "m")).alias("f")).select("f.m")
        centers = cut_lineage(centers.join(of(f"c{n}", n), "k", "full"))
    before = None
    for _ in range(max_iter):
        labelled = stored(_nearest(rows, norms, centers, k), "labelled")
        cost = labelled.agg(F.sum("d")).first()[0]
        if cost is None or (before is not None and before - cost <= tol * before):
            break
        before = cost
        centers = cut_lineage(_means(rows, labelled, k))
    found = _nearest(rows, norms, centers, k)
    return found.select(F.col("m").alias(member), "label", F.sqrt("d").alias("distance"))
