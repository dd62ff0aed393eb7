"""Reachability audit of SQL-injection events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.flows import is_sql_injection
from flowlens.operators.skew import salted_lookup

REACH_MS = 1000  # an event is reached by a log less than this away
SLAB_MS = 60_000


def injection_events(logs: DataFrame) -> DataFrame:
    return logs.where(is_sql_injection(F.col("eventname")))


def audit_rows(logs: DataFrame) -> DataFrame:
    """Row-level form: every event beside every other log of its address pair, with the reach of the pair of rows.

    Grows with events times logs per address pair; ``audit_reach`` gives the same verdicts without that join. It stays
    as the readable definition that the fast form is tested against.
    """
    events = injection_events(logs)
    other = logs.select(
        F.col("row").alias("__row"), F.col("sourceip").alias("__s"), F.col("destip").alias("__d"),
        F.col("orglog").alias("alllog"), F.col("firstrecvtime").alias("logtime"),
    )
    met = (
        (F.col("sourceip") == F.col("__s")) & (F.col("destip") == F.col("__d")) & (F.col("row") != F.col("__row"))
    )
    gap = F.col("firstrecvtime") - F.col("logtime")
    near = F.col("alllog").contains("sql") & (gap < REACH_MS) & (gap > -REACH_MS)
    return events.join(other, met, "left").withColumn("reach", F.when(near, "1").otherwise("0")).drop("__row", "__s", "__d")


def _near_counts(logs: DataFrame) -> DataFrame:
    """Logs mentioning sql less than REACH_MS around every time of an address pair: ``sourceip, destip, t, near``.

    Logs are counted per millisecond first. The time line of a pair is cut into slabs, each with the edges of its
    neighbours, so a window partition holds at most SLAB_MS + 2 * REACH_MS rows however busy the pair is.
    """
    per_ms = logs.groupBy("sourceip", "destip", F.col("firstrecvtime").alias("t")).agg(
        F.count_if(F.coalesce(F.col("orglog").contains("sql"), F.lit(False))).alias("n")
    )
    reach = REACH_MS - 1
    own = F.floor(F.col("t") / SLAB_MS)
    slabs = F.sequence(F.floor((F.col("t") - reach) / SLAB_MS), F.floor((F.col("t") + reach) / SLAB_MS))
    placed = per_ms.where(F.col("t").isNotNull()).withColumn("own", own).withColumn("slab", F.explode(slabs))
    around = Window.partitionBy("sourceip", "destip", "slab").orderBy("t").rangeBetween(-reach, reach)
    counted = placed.withColumn("near", F.sum("n").over(around)).where(F.col("slab") == F.col("own"))
    return counted.select("sourceip", "destip", "t", "near")


def audit_reach(logs: DataFrame) -> DataFrame:
    """Events with reach '1', '0' or both: one row each, from counts instead of row pairs.

    Reach '1' needs another log that mentions sql less than REACH_MS away; reach '0' needs another log that does not
    qualify, or no other log at all. ``row`` is the key of a log. Times are whole milliseconds.
    """
    pairs = logs.where(F.col("row").isNotNull()).groupBy("sourceip", "destip").agg(F.count(F.lit(1)).alias("__all"))
    near = _near_counts(logs).withColumnRenamed("t", "firstrecvtime")
    events = injection_events(logs)
    joined = events.join(near, ["sourceip", "destip", "firstrecvtime"], "left")
    joined = salted_lookup(joined, pairs, ["sourceip", "destip"], "row", counted=events)
    itself = F.when(F.col("firstrecvtime").isNotNull() & F.col("orglog").contains("sql"), 1).otherwise(0)
    others = F.when(F.col("row").isNull(), 0).otherwise(F.coalesce(F.col("__all") - 1, F.lit(0)))
    qualifying = F.when(F.col("row").isNull(), 0).otherwise(F.coalesce(F.col("near") - itself, F.lit(0)))
    reach = F.array_compact(
        F.array(F.when(qualifying > 0, "1"), F.when((others == 0) | (qualifying < others), "0"))
    )
    return joined.withColumn("reach", F.explode(reach)).select(*logs.columns, "reach").distinct()
