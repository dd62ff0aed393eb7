"""Grouped summaries of flow and audit records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.flows import IN_TO_IN, IN_TO_OUT, OUT_TO_IN

# Feature order of the stored reports.
SEVEN_FEATURES = ("tcp", "udp", "icmp", "gre", "costtime", "packernum", "bytesize")
FOUR_FEATURES = ("tcp", "udp", "packernum", "bytesize")


def own_side(flows: DataFrame, columns: tuple[str, ...] = SEVEN_FEATURES) -> DataFrame:
    """One row per flow and monitored end: the source of outgoing and inner flows, the destination of incoming ones."""
    d = F.col("flowd")
    ip = F.when(d.isin(IN_TO_OUT, IN_TO_IN), F.col("srcip")).when(d == OUT_TO_IN, F.col("dstip"))
    # a generator: a derived direction is computed once per row, not again in a filter pushed below it
    return flows.select(F.explode(F.array_compact(F.array(ip))).alias("ip"), "flowd", *columns)


def ip_totals(flows: DataFrame, features: tuple[str, ...] = SEVEN_FEATURES) -> DataFrame:
    """Feature sums per address."""
    return flows.groupBy("ip").agg(*[F.sum(f).alias(f) for f in features])


def visit_counts(visits: DataFrame) -> DataFrame:
    """Visits per (ip, host, time) and per (ip, host), told apart by ``level``.

    The finer level is aggregated first; the coarser one sums its few rows.
    """
    fine = visits.groupBy("ip", "host", "time").agg(F.count("host").alias("count"))
    both = fine.groupingSets([["ip", "host", "time"], ["ip", "host"]], "ip", "host", "time").agg(
        F.sum("count").alias("count"), F.grouping_id().alias("__g")
    )
    level = F.when(F.col("__g") == 0, "ip_host_time").otherwise("ip_host")
    return both.select(level.alias("level"), "ip", "host", "time", "count")


def flow_sessions(flows: DataFrame) -> DataFrame:
    """Sums, flow count and distinct ports per (time, source, destination, protocol). At most 65,536 ports a set."""

    def ports(column: str) -> Column:
        return F.sort_array(F.collect_set(column))

    grouped = flows.groupBy("recordtime", "srcip", "dstip", "proto").agg(
        F.sum("costtime").alias("costtime"), F.sum("packernum").alias("packernum"), F.sum("bytesize").alias("bytesize"),
        F.count(F.lit(1)).alias("flownuma"), ports("srcport").alias("__s"), ports("dstport").alias("__d"),
    )
    return grouped.select(
        "recordtime", "srcip", "dstip", "proto", "costtime", "packernum", "bytesize", "flownuma",
        F.size("__s").cast("bigint").alias("flownums"), F.size("__d").cast("bigint").alias("flownumd"),
        F.array_join(F.col("__s").cast("array<string>"), ",").alias("srcports"),
        F.array_join(F.col("__d").cast("array<string>"), ",").alias("dstports"),
    )


def cluster_sizes(points: DataFrame, label: str = "label") -> DataFrame:
    return points.groupBy(label).agg(F.count(F.lit(1)).alias("cluster_size"))


def cluster_centers(points: DataFrame, features: tuple[str, ...], label: str = "label") -> DataFrame:
    """Mean of the raw features per label."""
    return points.groupBy(label).agg(*[F.avg(f).alias(f) for f in features])


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, population deviation and maximum of every column, in one row."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def baskets(visits: DataFrame) -> DataFrame:
    """Distinct hosts per address and hour, one row each, with their visits.

    Long form: a basket of a busy address may hold any number of hosts and is never gathered into one cell.
    """
    return visits.groupBy("ip", "hour", "host").agg(F.count(F.lit(1)).alias("visits"))


def attack_summary(attacks: DataFrame) -> DataFrame:
    """Attack rows per type, ends, ports, time and flow count."""
    keys = ["attacktype", "srcip", "dstip", "proto", "srcport", "dstport", "recordtime", "flownums"]
    return attacks.groupBy(*keys).agg(F.count(F.lit(1)).alias("flownuma"))


def confusion_counts(scored: DataFrame, models: tuple[str, ...] = ("nb", "lr")) -> DataFrame:
    """One row per model: tp, fp, tn, fn with class 1 as normal, in one pass."""
    label = F.col("label")

    def cells(model: str) -> Column:
        p = F.col(f"prediction_{model}")

        def n(actual: int, predicted: int) -> Column:
            return F.count_if((label == actual) & (p == predicted))

        return F.struct(
            F.lit(model).alias("model"), n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(0, 0).alias("tn"), n(1, 0).alias("fn")
        )

    return scored.agg(F.array(*[cells(m) for m in models]).alias("m")).select(F.inline("m"))


def confusion_report(counts: DataFrame) -> DataFrame:
    """Counts with precision and recall of each cell, as text with three decimals."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def cell(n: Column, predicted: Column, actual: Column) -> Column:
        def share(part: Column, whole: Column) -> Column:
            return F.coalesce(F.format_string("%.3f", F.try_divide(100.0 * part, whole)), F.lit("NaN"))

        return F.concat(
            n.cast("string"), F.lit("||precision:"), share(n, predicted), F.lit("% recall:"), share(n, actual), F.lit("%")
        )

    return counts.select(
        "model",
        cell(tp, tp + fp, tp + fn).alias("actual1_predicted1"), cell(fn, tn + fn, tp + fn).alias("actual1_predicted0"),
        cell(fp, tp + fp, fp + tn).alias("actual0_predicted1"), cell(tn, tn + fn, fp + tn).alias("actual0_predicted0"),
    )


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return scored.agg(F.count(F.lit(1)).alias("n"), (100.0 * F.avg(hit)).alias("accuracy"))


def exact_median(df: DataFrame, column: str, eps: float = 1e-4) -> float | None:
    """Exact median without gathering the column: a quantile sketch brackets it, only the bracket is sorted.

    None if the column holds no number.
    """
    ends = df.approxQuantile(column, [0.5 - 2 * eps, 0.5 + 2 * eps], eps)
    if not ends:
        return None
    lo, hi = ends
    value = F.col(column)
    n, below = df.agg(F.count(value), F.count_if(value < lo)).first()
    first, last = (n - 1) // 2 - below, n // 2 - below
    bracket = df.where(value.between(lo, hi)).select(value).orderBy(value)
    middle = [r[0] for r in bracket.offset(first).limit(last - first + 1).collect()]  # one or two values
    return sum(middle) / len(middle)


def median_labels(points: DataFrame) -> DataFrame:
    """Four-way tag of (proto, flow) against their medians: 0 low/low, 1 low/high, 2 high/low, 3 high/high."""
    high_proto = F.col("proto") > F.lit(exact_median(points, "proto"))
    high_flow = F.col("flow") > F.lit(exact_median(points, "flow"))
    return points.withColumn("tag", (F.when(high_proto, 2).otherwise(0) + F.when(high_flow, 1).otherwise(0)).cast("string"))


def crosstab(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Contingency counts in long form."""
    return df.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))


def multiclass_metrics(pairs: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted precision, recall and F1 from the confusion counts."""
    cells = pairs.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"),
                         F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("actual", "predicted", "hit")])
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("actual")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    per = per.withColumns({"p": precision, "r": recall}).withColumn("f", f1)
    total = F.sum("actual")
    return per.agg(
        (F.sum("hit") / total).alias("accuracy"), (F.sum(F.col("p") * F.col("actual")) / total).alias("weighted_precision"),
        (F.sum(F.col("r") * F.col("actual")) / total).alias("weighted_recall"),
        (F.sum(F.col("f") * F.col("actual")) / total).alias("f1"),
    )


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """First k rows of every group; Spark limits each group before the shuffle, so a group sends k rows a task."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def joined_text(ranked: DataFrame, group: str, value: str, sep: str = "#") -> DataFrame:
    """Ranked values of a group joined in rank order; call it on at most a few rows a group."""
    rows = F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("v"))))
    return ranked.groupBy(group).agg(F.array_join(F.transform(rows, lambda r: r["v"]), sep).alias("top_hosts"))
