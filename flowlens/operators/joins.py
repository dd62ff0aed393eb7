"""Relational operators that combine flow, audit and result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.skew import label_lookup, salted_lookup, with_group_stats


def names_for_indexes(scored: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Names of user and item indexes from dimensions (ip, ip_index) and (host, host_index), rows may repeat."""
    named = salted_lookup(scored, users.select("ip_index", "ip").distinct(), ["ip_index"], "host_index")
    return salted_lookup(named, items.select("host_index", "host").distinct(), ["host_index"], "ip_index", counted=scored)


def similarity_reasons(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """Hosts both ends of a similar pair visited, with both counts and their ratio.

    ``pairs``: ip1, ip2, sim with ip1 < ip2. ``ratings``: ip, host, count (one row per ip and host). Starts from the
    published pairs, so the work grows with them and not with the pairs that meet in a busy host.
    """
    first = ratings.select(F.col("ip").alias("ip1"), "host", F.col("count").alias("ip1_count"))
    second = ratings.select(F.col("ip").alias("ip2"), "host", F.col("count").alias("ip2_count"))
    shared = pairs.select("ip1", "ip2", "sim").join(first, "ip1").join(second, ["ip2", "host"])
    return shared.select(
        "ip1", "ip2", "host", "sim", "ip1_count", "ip2_count", (F.col("ip1_count") / F.col("ip2_count")).alias("rate")
    )


ENDS = ("recordtime", "srcip", "dstip", "srcport", "dstport")


def _is_forward() -> tuple[Column, Column]:
    """Whether a flow goes toward the lower port, and whether it comes from there."""
    src, dst = F.col("srcport").try_cast("int"), F.col("dstport").try_cast("int")
    return src > dst, src < dst


def _turned() -> list[Column]:
    """The ends of the flow in the opposite direction."""
    own = ("recordtime", "dstip", "srcip", "dstport", "srcport")
    return [F.col(c).alias(f"__{name}") for name, c in zip(ENDS, own)]


def _met() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in ENDS])


def merge_reverse_flows(flows: DataFrame) -> DataFrame:
    """Flows toward the lower port, with the sums of the opposite direction added where it exists.

    Only rows with srcport > dstport are kept, so a partner has srcport < dstport: both sides are cut before the join.
    Several partners give several rows, so the rows of a busy pair of ends grow with the square of its flows: aggregates over
    them are taken from ``fold_reverse_flows``.
    """
    forward, backward = _is_forward()
    return with_reverse_flows(flows.where(forward), flows.where(backward))


def with_reverse_flows(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """The forward flows, which may carry further columns, once per backward flow between the same ends (at least once)."""
    keep = [c for c in forward.columns if c not in ("costtime", "packernum", "bytesize")]
    partners = backward.select(*_turned(), F.col("costtime").alias("__cost"), F.col("packernum").alias("__pk"), F.col("bytesize").alias("__by"))
    both = forward.join(partners, _met(), "left")

    def summed(own: str, other: str) -> Column:
        return F.coalesce(F.col(own) + F.col(other), F.col(own)).alias(own)

    return both.select(*keep, summed("costtime", "__cost"), summed("packernum", "__pk"), summed("bytesize", "__by"))


def fold_reverse_flows(flows: DataFrame, top: int) -> DataFrame:
    """The rows of ``merge_reverse_flows`` folded, without writing a pair of flows out.

    A row stands for a forward flow with those of its partners whose packets are told apart below ``top`` only: their number
    ``n_flows``, ``packernum`` (the packets together, or at least ``top``, for that many and more) and, as ``pk_*`` and ``by_*``,
    number, sum, mean, squared deviations and maximum of packets and bytes. The backward flows are folded before they meet:
    all flows of so many packets that they bring any sum to ``top`` are one row.
    """
    forward, backward = _is_forward()
    pk, by = F.col("packernum").cast("double"), F.col("bytesize").cast("double")
    least = flows.agg(F.least(F.lit(0.0), F.min(pk))).scalar()
    # a partner without a number adds nothing
    rows = flows.where(backward).select(*_turned(), F.coalesce(pk, F.lit(0.0)).alias("__pk"), F.coalesce(by, F.lit(0.0)).alias("__by"))
    packets = F.least(F.col("__pk"), F.lit(float(top)) - least)
    partners = rows.groupBy(*[f"__{c}" for c in ENDS], packets.alias("__packets")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[c for v in ("__pk", "__by") for c in (F.sum(v).alias(f"{v}_sum"), F.var_pop(v).alias(f"{v}_var"), F.max(v).alias(f"{v}_max"))],
    )
    own = flows.where(forward).select("row", *ENDS, "proto", pk.alias("pk"), by.alias("by"))
    both = own.join(partners, _met(), "left")
    n, zero = F.coalesce("__n", F.lit(1)), F.lit(0.0)

    def merged(name: str) -> list[Column]:
        v, add = F.col(name), lambda c: F.coalesce(F.col(f"__{name}_{c}"), zero)
        return [
            F.when(v.isNotNull(), n).otherwise(0).alias(f"{name}_n"), (v * n + add("sum")).alias(f"{name}_sum"),
            (v + add("sum") / n).alias(f"{name}_mean"), F.when(v.isNotNull(), add("var") * n).alias(f"{name}_dev"), (v + add("max")).alias(f"{name}_max"),
        ]

    return both.select(
        F.xxhash64("row", "__packets").alias("row"), *ENDS, "proto", (F.col("pk") + F.coalesce("__packets", zero)).alias("packernum"),
        n.alias("n_flows"), *merged("pk"), *merged("by"),
    )


def with_group_size(df: DataFrame, keys: list[str], by: str = "row", name: str = "flownums") -> DataFrame:
    """Rows with the number of rows that share their keys."""
    return with_group_stats(df, keys, by, **{name: F.count(F.lit(1))})


def flows_to_audit(flows: DataFrame, audit: DataFrame, by: str = "id") -> DataFrame:
    """Audit rows of the clustered flows they belong to, for all cluster labels at once.

    ``flows``: ip, srcport, dstport, prediction. Flows with equal keys and label are folded into ``n_flows`` first, so
    the join grows with the audit rows and not with flows times audit rows.
    """
    keys = ["ip", "srcport", "dstport"]
    folded = flows.groupBy(*keys, "prediction").agg(F.count(F.lit(1)).alias("n_flows"))
    return salted_lookup(audit, folded, keys, by, "inner")


def latest_records(found: DataFrame, ip: str, time: str, **columns: Column) -> DataFrame:
    """Maxima of ``columns`` over the rows of the latest time of each address.

    Two partial aggregations instead of a ranking window, so a busy address is never held by one task.
    """
    per_time = found.groupBy(F.col(ip).alias("ip"), F.col(time).alias("__time")).agg(
        *[F.max(c).alias(n) for n, c in columns.items()]
    )
    newest = per_time.groupBy("ip").agg(F.max(F.struct("__time", *columns)).alias("__r"))
    return newest.select("ip", F.col("__r.__time").alias("storagetime"), *[F.col(f"__r.{n}").alias(n) for n in columns])


def with_last_result(current: DataFrame, last: DataFrame | None) -> DataFrame:
    """Current labels beside the labels of the previous run, and whether they differ.

    Keys are (ip, label): an address may carry two outlier labels. ``last``: ip, label; None on the first run.
    """
    if last is None:
        return current.withColumns({"last_label": F.lit("0"), "changed": F.lit(False)})
    before = last.select("ip", F.col("label").alias("last_label")).distinct()
    joined = current.join(before, "ip", "left").distinct()
    return joined.withColumn("changed", ~F.col("label").eqNullSafe(F.col("last_label")))


def changed_flag(same_is_one: bool, first_run: bool = False) -> Column:
    """Stored encoding of ``changed``: the two report layouts encode it oppositely; a first run is '0' in both."""
    if first_run:
        return F.lit("0")
    on_same, on_change = ("1", "0") if same_is_one else ("0", "1")
    return F.when(F.col("changed"), on_change).otherwise(on_same)


def with_baseline(day: DataFrame, baseline: DataFrame, keys: list[str], by: str = "row") -> DataFrame:
    """Day rows with the bounds of their keys; a hot key of the day rows is spread over many tasks."""
    return salted_lookup(day, baseline, keys, by)


def with_centers(points: DataFrame, centers: DataFrame, label: str = "label", few: bool = False) -> DataFrame:
    """Points with the center of their label; ``few``: the labels are a model's."""
    return label_lookup(points, centers, label, few=few)


def members_with_top_hosts(members: DataFrame, top: DataFrame) -> DataFrame:
    """Cluster members with the top-host text of their cluster."""
    return label_lookup(members, top, few=True)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def keep_listed(df: DataFrame, listed: DataFrame, column: str, listed_column: str = "ip") -> DataFrame:
    """Rows whose value is in a list."""
    values = listed.select(F.col(listed_column).alias("__listed")).distinct()
    return df.join(values, df[column] == F.col("__listed"), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, column: str, listed_column: str = "ip") -> DataFrame:
    """Rows whose value is not in a list; duplicates of the left side stay."""
    values = listed.select(F.col(listed_column).alias("__listed")).distinct()
    return df.join(values, df[column] == F.col("__listed"), "left_anti")


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left side whose value, null cells included, is not on the right side; columns match by name.

    Every copy of a found value goes, copies of the others stay.
    """
    values = right.select(*left.columns).distinct().toDF(*[f"__{c}" for c in left.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in left.columns])
    return left.join(values, same, "left_anti")
