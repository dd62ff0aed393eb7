"""Behaviour groups of assets: quadrant labels, their centers and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.flows import pack_features, truncated
from flowlens.operators.scaling import with_table_stats
from flowlens.operators.skew import label_lookup

# Labels.
OUTLIER_LABELS = ("other_high_proto", "other_high_flow")


def quadrant_labels(scored: DataFrame) -> DataFrame:
    """Labels from the means and 3-sigma bounds of ``proto`` and ``flow``; a doubly outlying row appears twice."""
    with_moments = with_table_stats(
        scored, "__m", p=F.avg("proto"), f=F.avg("flow"), p_hi=F.avg("proto") + 3 * F.stddev_pop("proto"),
        f_hi=F.avg("flow") + 3 * F.stddev_pop("flow"),
    )
    out_proto, out_flow = F.col("proto") > F.col("__m.p_hi"), F.col("flow") > F.col("__m.f_hi")
    high_proto, high_flow = F.col("proto") > F.col("__m.p"), F.col("flow") > F.col("__m.f")
    side = F.concat(
        F.when(high_proto, "high").otherwise("low"), F.lit("_"), F.when(high_flow, "high").otherwise("low")
    )
    labels = F.array(
        F.when(out_proto, OUTLIER_LABELS[0]), F.when(out_flow, OUTLIER_LABELS[1]), F.when(~(out_proto | out_flow), side)
    )
    return with_moments.withColumn("label", F.explode(F.array_compact(labels))).drop("__m")


def euclidean(a: list[Column], b: list[Column]) -> Column:
    total = F.lit(0.0)
    for x, y in zip(a, b):
        total = total + (x - y) * (x - y)
    return F.sqrt(total)


def center_distances(labelled: DataFrame, features: tuple[str, ...], suffix: str = "_scl") -> DataFrame:
    """Packed features and center of every member, and its distance to the center in scaled features.

    Centers are means of the raw features divided by the column maximum. Outlier labels carry center '0' and distance 0.
    """
    normal = labelled.where(~F.col("label").isin(*OUTLIER_LABELS))
    means = normal.groupBy("label").agg(*[F.avg(f).alias(f"{f}_mean") for f in features])
    joined = with_table_stats(labelled, "__top", **{f: F.max(f) for f in features})
    joined = label_lookup(joined, means, few=True)
    scaled_center = [
        F.when(F.col(f"__top.{f}") == 0, F.lit(0.0)).otherwise(F.col(f"{f}_mean") / F.col(f"__top.{f}")) for f in features
    ]
    outlier = F.col("label").isin(*OUTLIER_LABELS)
    distance = euclidean([F.col(f + suffix) for f in features], scaled_center)
    return joined.select(
        "ip", "label", *features,
        pack_features([F.col(f) for f in features]).alias("features"),
        F.when(outlier, "0").otherwise(pack_features([F.round(f"{f}_mean", 6) for f in features])).alias("center"),
        F.when(outlier, F.lit(0.0)).otherwise(distance).alias("distance"),
    )


def high_low_labels(
    points: DataFrame, centers: DataFrame, proto: tuple[tuple[str, float], ...], flow: tuple[tuple[str, float], ...], few: bool = False
) -> DataFrame:
    """Cluster label from the weighted score of its center against the mean score of all rows; 'other' passes through.

    ``points``: label, raw features, proto, flow. ``centers``: label and mean raw features. ``few``: the labels are a model's.
    """
    names = [f for f, _ in (*proto, *flow)]
    tops = {f"{f}_top": F.max(f) for f in names}
    overall = points.agg(F.struct(*[c.alias(n) for n, c in tops.items()], F.avg("proto").alias("proto"), F.avg("flow").alias("flow"))).scalar()
    centers = centers.withColumn("__m", overall)

    def score(parts: tuple[tuple[str, float], ...]) -> Column:
        out = F.lit(0.0)
        for f, w in parts:
            biggest = F.col(f"__m.{f}_top")
            out = out + w * F.when(biggest == 0, F.lit(0.0)).otherwise(F.col(f) / biggest)
        return out

    def word(value: Column, bound: Column) -> Column:
        return F.when(value > bound, "high").otherwise("low")

    added = F.concat(
        word(score(proto), F.col("__m.proto")), F.lit("#"), word(score(flow), F.col("__m.flow"))
    )
    per_label = centers.where(F.col("label") != "other").select("label", added.alias("add_label"))
    return label_lookup(points, per_label, few=few).withColumn("add_label", F.coalesce("add_label", "label"))


def under_upper_labels(points: DataFrame, bounds: DataFrame) -> DataFrame:
    """Variant: mean proto and flow of a label against given bounds (one row: proto, flow), 'upper' or 'under'."""
    b = bounds.agg(F.struct(F.max("proto").alias("proto"), F.max("flow").alias("flow"))).scalar()

    def word(c: str) -> Column:
        return F.when(F.avg(c) > b.getField(c), "upper").otherwise("under")

    return points.groupBy("label").agg(F.concat(word("proto"), F.lit("_"), word("flow")).alias("add_feature"))


def point_report(members: DataFrame, names: tuple[str, ...], packed: str = "features") -> DataFrame:
    """Cluster points with the '#'-joined features spread over named columns."""
    parts = F.split(F.col(packed), "#")
    return members.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def center_report(members: DataFrame, names: tuple[str, ...], center: str = "center") -> DataFrame:
    """Distinct (label, center) with the center spread over named columns; zeros for a sentinel center."""
    parts = F.split(F.col(center), "#")
    spread = {n: F.when(F.size(parts) == 1, "0").otherwise(F.get(parts, F.lit(i))) for i, n in enumerate(names)}
    return members.select("label", F.col(center).alias("center")).distinct().withColumns(spread)


def truncated_center(centers: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Centers as '#'-joined integers, '-1' for the outlier label."""
    packed = F.concat_ws("#", *[truncated(F.round(f, 6)).cast("string") for f in features])
    return centers.withColumn("center", F.when(F.col("label") == "other", "-1").otherwise(packed))
