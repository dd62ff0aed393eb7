"""Port portraits: port classes of every asset, their baselines and verdicts.

The asset is a grouping key: one pass covers all of them. Merged flows may come folded (``joins.fold_reverse_flows``), with
``n_flows`` merged rows to a row: then the number of pairs of flows does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.flows import hour_label, truncated
from flowlens.operators.baselines import KB, _level, fine_moments, merged_deviation, merged_mean
from flowlens.operators.joins import with_reverse_flows
from flowlens.operators.skew import salted_lookup
from flowlens.session import cut_lineage, stored

# Port classes and thresholds.
REGULAR, SUSPECT, OUTGOING, OPEN = "0", "1", "2", "3"
RARE_SHARE, RARE_FLOOR, RARE_FIXED = 0.00375, 10, 30
WEB_PORTS = (80, 443)

# Grouping ids of (port, proto, hour) and of (port, proto): a set bit is a rolled-up column.
_BY_HOUR = {0: "PORTPROTO", 2: "PORT", 4: "PROTO", 6: "ALL"}
_NO_HOUR = {0: "PORTPROTO", 1: "PORT", 2: "PROTO", 3: "ALL"}


# Most packets that the rules tell apart.
MOST_PACKETS = 3


def _is_folded(flows: DataFrame) -> bool:
    return "n_flows" in flows.columns


def rare_threshold(flows: DataFrame) -> Column:
    """max(10, floor(0.00375 * rows))."""
    rows = F.sum("n_flows") if _is_folded(flows) else F.count(F.lit(1))
    return flows.agg(F.greatest(F.lit(RARE_FLOOR), F.floor(rows * RARE_SHARE)).cast("bigint")).scalar()


def _port_hits(flows: DataFrame) -> DataFrame:
    n = F.sum(F.when(F.col("dstport").isNotNull(), F.col("n_flows")).otherwise(0)) if _is_folded(flows) else F.count("dstport")
    return flows.groupBy("dstip", "dstport").agg(n.alias("hits"))


def rare_ports(flows: DataFrame, threshold: Column) -> DataFrame:
    """Destination ports of an asset with fewer flows than the threshold."""
    return _port_hits(flows).where(F.col("hits") < threshold)


def _asset_rows(marked: DataFrame) -> DataFrame:
    """Every flow once per asset it belongs to (source and destination)."""
    return marked.withColumn("name", F.explode(F.array_distinct(F.array("srcip", "dstip"))))


def _with_rarity(flows: DataFrame, counted: DataFrame) -> DataFrame:
    """Flows with the rarity of their destination port, by share of ``counted``, which has all their ports.

    Ports that are not rare hold the share of the rows each, so there are less than 300 of them: these are broadcast, and no
    flow is shuffled.
    """
    common = cut_lineage(_port_hits(counted).where(F.col("hits") >= rare_threshold(counted)))
    found = common.select("dstip", "dstport", F.lit(True).alias("__common"))
    # a flow without an address or port meets no port, rare or not
    rare = F.col("dstip").isNotNull() & F.col("dstport").isNotNull() & F.col("__common").isNull()
    return flows.join(F.broadcast(found), ["dstip", "dstport"], "left").withColumn("rare", rare).drop("__common")


def _open_port(cls: Column) -> Column:
    """Regular TCP and any UDP of two packets become open ports: UDP also overrides the outgoing class."""
    tcp, udp = F.col("proto") == "TCP", (F.col("proto") == "UDP") & (F.col("packernum") >= 2)
    return F.when(((cls == REGULAR) & tcp) | udp, OPEN).otherwise(cls)


def classify_ports(flows: DataFrame) -> DataFrame:
    """Port, class and index of every flow for each of its assets; rare ports by share of the whole input."""
    return _classified(_asset_rows(_with_rarity(flows, flows)))


def _classified(rows: DataFrame) -> DataFrame:
    outgoing = F.col("srcip") == F.col("name")
    packets, dst = F.col("packernum"), F.col("dstport")
    web, low = dst.isin(*WEB_PORTS), dst < 1024
    first = (
        F.when(outgoing, OUTGOING)
        .when(low & (packets >= 2), F.when(F.col("rare") & ~web, SUSPECT).otherwise(REGULAR))
        .when(packets >= 2, SUSPECT)
        .otherwise("")
    )
    port = F.when(outgoing, F.col("srcport")).when(packets >= 2, dst)
    noticed = F.col("rare") & ~outgoing & (F.col("proto") == "TCP") & (packets >= 3) & ~web
    other = outgoing | noticed | (~low & (packets >= 2))
    step1 = rows.withColumns(
        {
            "port": F.coalesce(port.cast("string"), F.lit("")),
            "abport": F.when(noticed, SUSPECT).otherwise(first),
            "index": F.when(other, "other").otherwise(""),
        }
    )
    return step1.withColumn("abport", _open_port(F.col("abport"))).drop("rare")


def classify_ports_simple(flows: DataFrame) -> DataFrame:
    """Newer form: every incoming port is regular unless it is rare; fixed rarity threshold."""
    rare = rare_ports(flows, F.lit(RARE_FIXED)).select("dstip", "dstport", F.lit(True).alias("rare"))
    marked = salted_lookup(flows, rare, ["dstip", "dstport"], "row")
    rows = _asset_rows(marked.withColumn("rare", F.coalesce("rare", F.lit(False))))
    outgoing = F.col("srcip") == F.col("name")
    noticed = F.col("rare") & ~outgoing & (F.col("proto") == "TCP") & (F.col("packernum") >= 2)
    step1 = rows.withColumns(
        {
            "port": F.when(outgoing, F.col("srcport")).otherwise(F.col("dstport")).cast("string"),
            "abport": F.when(outgoing, OUTGOING).when(noticed, SUSPECT).otherwise(REGULAR),
            "index": F.when(outgoing | noticed, "other").otherwise(""),
        }
    )
    return step1.withColumn("abport", _open_port(F.col("abport"))).drop("rare")


def _two_places(column: str) -> Column:
    """Two decimals, half up, with the noise of floating-point sums removed first."""
    return F.round(F.round(column, 6), 2).alias(column)


def _rolled(column: str, mask: int) -> Column:
    return F.when(F.col("__g").bitwiseAND(F.lit(mask)) == 0, F.col(column)).otherwise("").alias(column)


def _only_open(levels: DataFrame, fine: DataFrame) -> DataFrame:
    """Level rows whose port and protocol occur among the open ports of the asset ('' stands for every one)."""
    opened = fine.where(F.col("opened") > 0)
    ports = opened.select("name", "port").where(F.col("port") != " ").distinct().withColumn("open_port", F.lit(True))
    protos = opened.select("name", "proto").where(F.col("proto") != " ").distinct().withColumn("open_proto", F.lit(True))
    joined = levels.join(ports, ["name", "port"], "left").join(protos, ["name", "proto"], "left")
    port_ok = F.col("baseline").isin("ALL", "PROTO") | F.col("open_port")
    proto_ok = F.col("baseline").isin("ALL", "PORT") | F.col("open_proto")
    return joined.where(port_ok & proto_ok).drop("open_port", "open_proto")


def port_baseline_3sigma(classified: DataFrame) -> DataFrame:
    """Lower and upper bounds (mean -/+ 3 sample deviations) over open ports per asset and hour; single rows drop out."""
    # the flows are grouped once, at the finest level; the other three are merged from its rows
    keys = ["name", "port", "proto", hour_label(F.col("recordtime")).alias("hour")]
    opened = classified.where(F.col("abport") == OPEN)
    if _is_folded(classified):  # rows of equal weight together, so their means need no weights
        found = []
        for v in ("pk", "by"):
            mean, n = F.col(f"{v}_mean"), F.count(f"{v}_mean") * F.col("n_flows")
            found += [n.alias(f"{v}_n"), F.avg(mean).alias(f"{v}_mean"), (F.var_pop(mean) * n + F.sum(f"{v}_dev")).alias(f"{v}_dev")]
        fine = opened.groupBy(*keys, "n_flows").agg(*found)
    else:
        fine = opened.groupBy(*keys).agg(*fine_moments(pk=F.col("packernum").cast("double"), by=F.col("bytesize").cast("double")))
    sets = [["name", "hour"], ["name", "port", "hour"], ["name", "proto", "hour"], ["name", "port", "proto", "hour"]]
    levels = fine.groupingSets(sets, "name", "port", "proto", "hour").agg(
        merged_mean("pk").alias("pk"), merged_deviation("pk").alias("pk_std"), merged_mean("by").alias("by"),
        merged_deviation("by").alias("by_std"), F.grouping_id().alias("__g"),
    )

    def bound(mean: str, std: str, sign: int) -> Column:
        value = F.round(F.col(mean) + sign * 3 * F.col(std), 6)
        return truncated(F.greatest(F.lit(0.0), value) if sign < 0 else value)

    return levels.where(F.col("pk_std").isNotNull()).select(
        "name", _rolled("port", 4), _rolled("proto", 2), "hour",
        bound("pk", "pk_std", -1).alias("connectdown"), bound("pk", "pk_std", 1).alias("connectup"),
        bound("by", "by_std", -1).alias("netflowdown"), bound("by", "by_std", 1).alias("netflowup"),
        _level(_BY_HOUR).alias("baseline"),
    )


def port_baseline_max(classified: DataFrame) -> DataFrame:
    """Largest packets and KB per asset and hour on four levels, kept where port and protocol are open."""
    pk, by = ("pk_max", "by_max") if _is_folded(classified) else ("packernum", "bytesize")
    fine = classified.groupBy("name", "port", "proto", hour_label(F.col("recordtime")).alias("hour")).agg(
        F.max(F.col(pk).cast("double")).alias("pk"), F.max(F.col(by).cast("double")).alias("by"),
        F.count_if(F.col("abport") == OPEN).alias("opened"),
    )
    fine = cut_lineage(fine)  # the only pass over the flows: levels and open lists read these few rows
    sets = [["name", "hour"], ["name", "port", "hour"], ["name", "proto", "hour"], ["name", "port", "proto", "hour"]]
    levels = fine.groupingSets(sets, "name", "port", "proto", "hour").agg(
        F.max("pk").alias("connectavg"), (F.max("by") / KB).alias("netflowavg"), F.grouping_id().alias("__g")
    )
    named = levels.select(
        "name", _rolled("port", 4), _rolled("proto", 2), "hour", _two_places("connectavg"),
        _two_places("netflowavg"), _level(_BY_HOUR).alias("baseline"),
    )
    return _only_open(named, fine)


def port_baseline_3mean(classified: DataFrame) -> DataFrame:
    """Upper bounds of three means per asset on four levels, lower bounds 0, kept where port and protocol are open."""
    if _is_folded(classified):
        found = [F.sum("pk_sum").alias("pk"), F.sum("by_sum").alias("by"), F.sum("pk_n").alias("n_pk"), F.sum("by_n").alias("n_by")]
    else:
        found = [F.sum(F.col("packernum").cast("double")).alias("pk"), F.sum(F.col("bytesize").cast("double")).alias("by"),
                 F.count("packernum").alias("n_pk"), F.count("bytesize").alias("n_by")]
    fine = classified.groupBy("name", "port", "proto").agg(
        *found,
        F.count_if(F.col("abport") == OPEN).alias("opened"),
    )
    fine = cut_lineage(fine)
    sets = [["name"], ["name", "port"], ["name", "proto"], ["name", "port", "proto"]]
    levels = fine.groupingSets(sets, "name", "port", "proto").agg(
        (3 * F.sum("pk") / F.sum("n_pk")).alias("connectup"), (3 * F.sum("by") / F.sum("n_by") / KB).alias("netflowup"),
        F.grouping_id().alias("__g"),
    )
    named = levels.select(
        "name", _rolled("port", 2), _rolled("proto", 1), F.lit(0.0).alias("connectdown"),
        _two_places("connectup"), F.lit(0.0).alias("netflowdown"), _two_places("netflowup"), _level(_NO_HOUR).alias("baseline"),
    )
    return _only_open(named, fine)


def judge_ports(classified: DataFrame, baseline: DataFrame) -> DataFrame:
    """Verdict of open-port rows against the asset's known ports, protocols and overall bounds; other rows keep theirs."""
    return _verdicts(_with_bounds(classified, baseline))


def judge_merged_ports(flows: DataFrame, folded: DataFrame, baseline: DataFrame) -> DataFrame:
    """``judge_ports`` of the classified rows of ``merge_reverse_flows(flows)``; ``folded`` is ``fold_reverse_flows`` of them.

    What the rules look up (rare ports, known ports, bounds) depends on the forward flow alone, so it is looked up before the
    flows meet their partners: no pair of flows is shuffled. A row that is judged has its asset's own port.
    """
    src, dst = F.col("srcport").try_cast("int"), F.col("dstport").try_cast("int")
    rows = _asset_rows(_with_rarity(flows.where(src > dst), folded))
    own = F.when(F.col("srcip") == F.col("name"), F.col("srcport")).otherwise(F.col("dstport")).cast("string")
    known = _with_bounds(rows.withColumn("port", own), baseline).drop("port")
    judged = _verdicts(_classified(with_reverse_flows(known, flows.where(src < dst))))
    first = ["name", "port", "dstip", "dstport"]
    return judged.select(*first, *[c for c in flows.columns if c not in first], "abport", "index")


def _with_bounds(rows: DataFrame, baseline: DataFrame) -> DataFrame:
    # A few rows per asset, read three times. What is looked up is stored, so its size is known: if it allows, Spark broadcasts
    # it, and the rows are not shuffled.
    baseline = stored(baseline, "port-baseline")
    ports = stored(baseline.where(F.col("baseline") == "PORT").select("name", "port", F.lit(True).alias("known_port")), "known-ports")
    bounds = baseline.where(F.col("baseline") == "ALL").select("name", "connectup", "netflowup")
    # One row per asset: its bounds and its protocols (a few values).
    protos = baseline.where(F.col("baseline") == "PROTO").groupBy("name").agg(F.collect_set("proto").alias("protos"))
    assets = stored(bounds.join(protos, "name", "left"), "port-bounds")
    known = salted_lookup(rows, ports, ["name", "port"], "row")
    return salted_lookup(known, assets, ["name"], "row", counted=rows)


def _verdicts(rows: DataFrame) -> DataFrame:
    known_proto = F.coalesce(F.array_contains("protos", F.col("proto")), F.lit(False))
    number = F.coalesce(F.col("bytesize").cast("double") / KB, F.lit(0.0))
    packets = F.coalesce(F.col("packernum").cast("double"), F.lit(0.0))
    verdict = (
        F.when(F.col("abport") != OPEN, F.col("index"))
        .when(~known_proto, "protoabnormal")
        .when(F.col("known_port").isNull(), "portabnormal")
        .when(F.col("index") != "", F.col("index"))
        .when(number > F.coalesce("netflowup", F.lit(0.0)), "netflowabnormal")
        .when(packets > F.coalesce("connectup", F.lit(0.0)), "connectabnormal")
        .otherwise("normal")
    )
    return rows.withColumn("index", verdict).drop("known_port", "protos", "connectup", "netflowup")
