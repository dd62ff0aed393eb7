"""Dense integer indexes of names, and sparse vectors in long form."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.skew import salted_lookup

BUCKETS = 512


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values of a column with an index 0..n-1.

    Distinct names are hashed into equal buckets and numbered inside them; the bucket offsets come from one small
    window. Nothing passes through the driver. Join on the names and never publish the index.
    """
    names = df.select(column).distinct().withColumn("__b", F.pmod(F.xxhash64(column), F.lit(BUCKETS)))
    sizes = names.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    starts = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__b").orderBy(column))
    numbered = names.withColumn("__p", place).join(F.broadcast(starts), "__b")
    return numbered.select(column, (F.col("__start") + F.col("__p") - 1).cast("int").alias(out))


def index_users_items(ratings: DataFrame) -> DataFrame:
    """Ratings with ``ip_index`` and ``host_index``; they are read several times, so pass them computed (stored)."""
    users, items = dense_index(ratings, "ip", "ip_index"), dense_index(ratings, "host", "host_index")
    named = salted_lookup(ratings, users, ["ip"], "host", "inner")
    return salted_lookup(named, items, ["host"], "ip", "inner", counted=ratings)


def host_cells(ratings: DataFrame, value: str) -> DataFrame:
    """The sparse vector of every address in long form: ``ip, host, v, filled`` (its cells), ``length`` (all hosts).

    One row per cell, so no vocabulary is too large and no address has to fit into one row.
    """
    cells = ratings.groupBy("ip", "host").agg(F.sum(value).alias("v"))
    filled = cells.groupBy("ip").agg(F.count(F.lit(1)).alias("filled"))
    length = ratings.agg(F.countDistinct("host")).scalar()
    return salted_lookup(cells, filled, ["ip"], "host", "inner").withColumn("length", length)


def dense_vector(df: DataFrame, array: str, out: str = "vector") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))
