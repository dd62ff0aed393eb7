"""Feature scaling and weighted scores; column statistics come from one-row scalar subqueries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Weights:
    """Weights of the scaled features in the two group scores."""

    # Default weights.
    proto: tuple[tuple[str, float], ...] = (("tcp", 0.25), ("udp", 0.25), ("icmp", 0.25), ("gre", 0.25))
    flow: tuple[tuple[str, float], ...] = (("costtime", 0.33), ("packernum", 0.33), ("bytesize", 0.33))

    def limited_to(self, features: tuple[str, ...]) -> "Weights":
        return Weights(
            tuple(w for w in self.proto if w[0] in features), tuple(w for w in self.flow if w[0] in features)
        )


def with_table_stats(df: DataFrame, name: str, **stats: Column) -> DataFrame:
    """Aggregates over the whole table beside every row, as one struct column from a one-row scalar subquery."""
    one_row = df.agg(F.struct(*[c.alias(n) for n, c in stats.items()])).scalar()
    return df.withColumn(name, one_row)


def min_max_scale(df: DataFrame, features: tuple[str, ...], suffix: str = "_scl") -> DataFrame:
    """(x - min) / (max - min) per feature; 0.5 for a constant feature."""
    ends = {f: F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")) for f in features}

    def scaled(f: str) -> Column:
        lo, hi = F.col(f"__ends.{f}.lo"), F.col(f"__ends.{f}.hi")
        return F.when(hi == lo, F.lit(0.5)).otherwise((F.col(f) - lo) / (hi - lo))

    return with_table_stats(df, "__ends", **ends).withColumns({f + suffix: scaled(f) for f in features}).drop("__ends")


def scale_zero_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """x / max with the minimum fixed at 0; 0 when the maximum is 0."""
    top = F.col("__top.v")
    scaled = F.when(top == 0, F.lit(0.0)).otherwise(F.col(value) / top)
    return with_table_stats(df, "__top", v=F.max(value)).withColumn(out, scaled).drop("__top")


def weighted_scores(scaled: DataFrame, weights: Weights, suffix: str = "_scl") -> DataFrame:
    """Columns ``proto`` and ``flow``: weighted sums of the scaled features."""

    def total(parts: tuple[tuple[str, float], ...]) -> Column:
        out = F.lit(0.0)
        for f, w in parts:
            out = out + F.lit(w) * F.col(f + suffix)
        return out

    return scaled.withColumns({"proto": total(weights.proto), "flow": total(weights.flow)})
