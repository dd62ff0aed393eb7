"""End-to-end jobs: compositions of the operators, each a fixed number of distributed plans."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.functions.text import normalize_host, tokenize_uris
from flowlens.operators import aggregates as agg
from flowlens.operators import assets, audit, baselines, clustering, groups, indexing, itemsets, joins, models, ports
from flowlens.operators.scaling import Weights, min_max_scale, scale_zero_max, weighted_scores
from flowlens.operators.similarity import item_similarity, user_similarity
from flowlens.operators.skew import salted_lookup
from flowlens.operators.sparse import sparse_kmeans
from flowlens.session import cut_lineage, for_many_passes, stored

APP_FEATURES = tuple(a.lower() for a in ff.APP_PROTOCOLS)


# -- preparation ---------------------------------------------------------------------------------------------------


def prepare_netflow(raw: DataFrame, inner: list[str], unit: str = "s") -> DataFrame:
    """Index records to prepared flows: sums of both directions, duration, 0/1 protocols, direction."""
    hot = ff.one_hot(F.col("proto"), ff.FLOW_PROTOCOLS)
    return raw.select(
        F.col("recordid").alias("row"), "proto", ff.epoch_text(F.col("recordtime"), unit).alias("recordtime"),
        (F.col("uppkts") + F.col("downpkts")).alias("packernum"), (F.col("ups") + F.col("downs")).alias("bytesize"),
        "srcip", "dstip", "srcport", "dstport", *[c.alias(n) for n, c in hot.items()],
        (F.col("lasttime") - F.col("starttime")).alias("costtime"),
        ff.flow_direction(F.col("srcip"), F.col("dstip"), inner).alias("flowd"),
    )


def prepare_moniflow(raw: DataFrame, inner: list[str], inbound_only: bool = True) -> DataFrame:
    """Audit records with 0/1 columns and direction; by default only those from outside to inside."""
    hot = {**ff.one_hot(F.col("appproto"), ff.APP_PROTOCOLS, False), **ff.one_hot(F.col("method"), ff.HTTP_METHODS, False)}
    out = raw.select(
        F.col("id").alias("row"), "date", "srcip", "dstip", "appproto", "srcport", "dstport", "method", "uri", "host",
        *[c.alias(n) for n, c in hot.items()], ff.flow_direction(F.col("srcip"), F.col("dstip"), inner).alias("flowd"),
    )
    return out.where(F.col("flowd") == ff.OUT_TO_IN) if inbound_only else out


def prepare_stored_netflow(cells: DataFrame, inner: list[str]) -> DataFrame:
    """Catalog records to prepared flows; duration -1 when a time is missing."""
    hot = ff.one_hot(F.col("PROTO"), ff.FLOW_PROTOCOLS, False)
    start, end = F.col("STARTTIME").try_cast("timestamp"), F.col("ENDTIME").try_cast("timestamp")
    return cells.select(
        F.col("ROW").alias("row"), ff.missing_as_minus_one(ff.duration_ms(start, end)).alias("costtime"),
        *[c.alias(n) for n, c in hot.items()], F.col("PROTO").alias("proto"), F.col("PACKERNUM").alias("packernum"),
        F.col("BYTESIZE").alias("bytesize"), ff.flow_direction(F.col("SRCIP"), F.col("DSTIP"), inner).alias("flowd"),
        F.col("RECORDTIME").alias("recordtime"), F.col("SRCIP").alias("srcip"), F.col("DSTIP").alias("dstip"),
        F.col("SRCPORT").alias("srcport"), F.col("DSTPORT").alias("dstport"),
    )


# -- asset groups --------------------------------------------------------------------------------------------------


def scored_assets(
    flows: DataFrame, features: tuple[str, ...] = agg.SEVEN_FEATURES, listed: DataFrame | None = None,
    weights: Weights = Weights(),
) -> DataFrame:
    """Feature sums per monitored address with their scaled values and the two scores."""
    totals = agg.ip_totals(agg.own_side(flows, features), features)
    if listed is not None:
        totals = joins.keep_listed(totals, listed, "ip")
    # The totals are read by several statistics: compute them from the flows once.
    return cut_lineage(weighted_scores(min_max_scale(cut_lineage(totals), features), weights.limited_to(features)))


def asset_groups(
    flows: DataFrame, features: tuple[str, ...] = agg.SEVEN_FEATURES, listed: DataFrame | None = None,
    last: DataFrame | None = None,
) -> DataFrame:
    """Behaviour group, distance to its center and change since the last run for every address."""
    labelled = cut_lineage(groups.quadrant_labels(scored_assets(flows, features, listed)))  # one row per asset
    return joins.with_last_result(groups.center_distances(labelled, features), last)


# -- web behaviour -------------------------------------------------------------------------------------------------


def visits(moniflow: DataFrame, strict: bool = False) -> DataFrame:
    """HTTP visits as ip, host (normalised), hour and part of the day."""
    http = moniflow.where(ff.has_http_host(F.col("appproto"), F.col("host")))
    return http.select(
        F.col("srcip").alias("ip"), normalize_host(F.col("host"), strict).alias("host"), F.hour("date").alias("hour"),
        ff.time_of_day(F.col("date")).alias("time"),
    )


def behaviour_ratings(moniflow: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings (ip, host, time, count) and (ip, host, count)."""
    counts = cut_lineage(agg.visit_counts(visits(moniflow)).withColumn("count", F.col("count").cast("double")))
    return (
        counts.where(F.col("level") == "ip_host_time").drop("level"),
        counts.where(F.col("level") == "ip_host").drop("level", "time"),
    )


def behaviour_recommendations(moniflow: DataFrame, params: models.AlsParams = models.AlsParams()) -> DataFrame:
    """Recommended hosts per address and part of the day, scores divided by the largest."""
    timed, _ = behaviour_ratings(moniflow)
    indexed = indexing.index_users_items(timed).persist(StorageLevel.MEMORY_AND_DISK)
    top = models.recommend_by_day_part(indexed, params)
    named = joins.names_for_indexes(top, indexed, indexed)
    scaled = scale_zero_max(named, "score", "scores")
    return scaled.select("ip", F.col("host").alias("behav"), ff.decimals(F.col("scores"), 6).alias("scores"), "time")


def similar_addresses(rated: DataFrame, threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Pairs of similar addresses (ip1, ip2, sim) and the hosts they share."""
    users = user_similarity(rated, threshold)
    pairs = stored(users.select(F.col("left").alias("ip1"), F.col("right").alias("ip2"), "sim"), "similar")
    return pairs, joins.similarity_reasons(pairs, rated)


def similarity_report(pairs: DataFrame, first: str, second: str, data_type: str, cltime: str) -> DataFrame:
    """Published layout of similar pairs: row, object, other_object, sim, data_type, cltime."""
    out = pairs.select(
        ff.record_id(F.lit(data_type), F.col(first), F.col(second)).alias("row"), F.col(first).alias("object"),
        F.col(second).alias("other_object"), F.col("sim").cast("float").alias("sim"),
    )
    return out.withColumns({"data_type": F.lit(data_type), "cltime": F.lit(cltime)})


def behaviour_similarities(moniflow: DataFrame, cltime: str, threshold: float = 0.7) -> dict[str, DataFrame]:
    """Published tables: similar hosts (V), similar addresses (U) and the hosts similar addresses share."""
    _, rated = behaviour_ratings(moniflow)
    pairs, reasons = similar_addresses(rated, threshold)
    shared = reasons.select(
        ff.record_id(F.col("ip1"), F.col("ip2"), F.col("host")).alias("row"), F.col("ip1").alias("ip"), F.col("ip2").alias("other_ip"),
        "host", F.col("host").alias("other_host"), F.col("sim").cast("float").alias("sim"), F.col("ip1_count").cast("int").alias("ip_count"),
        F.col("ip2_count").cast("int").alias("other_ip_count"), F.col("rate").cast("float").alias("rate"), F.lit(cltime).alias("cltime"),
    )
    return {
        "items": similarity_report(item_similarity(rated), "left", "right", "V", cltime),
        "users": similarity_report(pairs, "ip1", "ip2", "U", cltime),
        "reasons": shared,
    }


def host_clusters(moniflow: DataFrame, k: int = 7) -> DataFrame:
    """Addresses clustered by the hosts they visit, with the ten hosts most members of a cluster visit."""
    _, rated = behaviour_ratings(moniflow)
    scaled = stored(scale_zero_max(rated, "count", "scaled"), "scaled")
    found = stored(sparse_kmeans(scaled, "ip", "host", "scaled", k), "host-clusters")
    members = clustering.mark_small_clusters(found, 2, "-1", drop_distance=True, few=True)
    hosts = salted_lookup(scaled.select("ip", "host"), members.select("ip", "label"), ["ip"], "host", "inner")
    counted = hosts.groupBy("label", "host").agg(F.count(F.lit(1)).alias("n"))
    top = agg.joined_text(agg.top_per_group(counted, "label", [F.desc("n"), F.asc("host")], 10), "label", "host")
    return joins.members_with_top_hosts(members, top)


def web_rules(moniflow: DataFrame, min_support: float = itemsets.MIN_SUPPORT, min_confidence: float = itemsets.MIN_CONFIDENCE) -> DataFrame:
    """Association rules between the hosts of each address, from its closed sets; no set is too large."""
    masks = cut_lineage(itemsets.basket_masks(visits(moniflow), min_support))
    return itemsets.closed_rules(itemsets.closed_sets(masks), masks, min_confidence)


# -- flows ---------------------------------------------------------------------------------------------------------


def netflow_clusters(flows: DataFrame, k: int = 10) -> DataFrame:
    """Source addresses clustered by their flow sums; the label and truncated center of every member."""
    features = agg.SEVEN_FEATURES
    totals = cut_lineage(agg.ip_totals(flows.withColumnRenamed("srcip", "ip"), features))
    scored = weighted_scores(min_max_scale(totals, features), Weights())
    vectors = for_many_passes(clustering.assemble(scored, [f + "_scl" for f in features]), "ip")
    members = clustering.mark_small_clusters(clustering.assign(clustering.kmeans_fit(vectors, k), vectors), few=True)
    centers = agg.cluster_centers(members, features)
    # the high/low label weighs packets and bytes but not the duration
    w = Weights().limited_to(tuple(f for f in features if f != "costtime"))
    described = groups.high_low_labels(members, centers, w.proto, w.flow, few=True)
    packed = groups.truncated_center(centers, features).select("label", "center")
    out = described.select("ip", "label", "add_label", "distance", *features, ff.pack_features([F.col(f) for f in features]).alias("features"))
    return joins.with_centers(out, packed, few=True)


def netflow_cluster_tables(members: DataFrame) -> dict[str, DataFrame]:
    """Published tables of ``netflow_clusters``: its points and its centers with one column per feature."""
    named = members.select("ip", "label", "distance", "features", "center")
    return {
        "points": groups.point_report(named.drop("center"), agg.SEVEN_FEATURES).drop("features"),
        "centers": groups.center_report(named, agg.SEVEN_FEATURES),
    }


def flow_outliers(flows: DataFrame, k: int | None = None) -> DataFrame:
    """Flow sessions ranked by the sum of two cluster-based outlier scores."""
    key = ["recordtime", "srcip", "dstip", "proto"]
    sessions = stored(agg.flow_sessions(flows), "sessions")
    triples = [["costtime", "packernum", "bytesize"], ["flownuma", "flownums", "flownumd"]]
    with ThreadPool(2) as pool:  # the two models do not depend on each other
        fitted = pool.map(lambda features: clustering.triple_model(sessions, features, key, k), triples)
    first = stored(clustering.triple_scores(sessions, triples[0], fitted[0], "1"), "scored-once")
    both = clustering.triple_scores(first, triples[1], fitted[1], "2")
    total = (F.col("unusual1") + F.col("unusual2")).alias("unusuals")
    return both.select("*", total).orderBy(F.desc("unusuals"))


# What port rules read of a flow.
PORT_COLUMNS = ["row", "srcip", "dstip", "srcport", "dstport", "proto", "recordtime", "costtime", "packernum", "bytesize"]


def _folded(flows: DataFrame, *values: str) -> DataFrame:
    """Merged flows folded, with these statistics only; they are read several times (rows, port counts, row count)."""
    folded = joins.fold_reverse_flows(flows.select(PORT_COLUMNS), ports.MOST_PACKETS)
    return stored(folded.select("row", *joins.ENDS, "proto", "packernum", "n_flows", *[f"{v}_{x}" for v in ("pk", "by") for x in values]), "folded")


def port_portrait_tables(today: DataFrame, history: DataFrame) -> dict[str, DataFrame]:
    """Published tables per asset: verdicts of today's flows, today's four-level maxima, the history's bounds."""
    bounds = ports.port_baseline_3mean(ports.classify_ports(_folded(history, "sum", "n")))
    now = _folded(today, "max")
    return {
        "verdicts": ports.judge_merged_ports(today.select(PORT_COLUMNS), now, bounds),
        "today": ports.port_baseline_max(ports.classify_ports(now)),
        "bounds": bounds,
    }


def port_portrait(today: DataFrame, history: DataFrame) -> DataFrame:
    """Port verdicts of today's flows against the ports, protocols and bounds of the history, per asset."""
    bounds = ports.port_baseline_3mean(ports.classify_ports(_folded(history, "sum", "n")))
    return ports.judge_merged_ports(today.select(PORT_COLUMNS), _folded(today), bounds)


def port_portrait_simple(flows: DataFrame) -> DataFrame:
    """Newer form: 3-sigma port baselines."""
    return ports.port_baseline_3sigma(ports.classify_ports_simple(_folded(flows, "mean", "dev")))


def flow_baseline_tables(day: DataFrame, week: DataFrame) -> dict[str, DataFrame]:
    """Published tables: day baseline and week baseline in the stored layout, and the verdicts of the day's flows."""
    bounds = cut_lineage(baselines.week_baseline(week))
    return {
        "day": baselines.baseline_report(baselines.day_baseline(day), "daybaseline"),
        "week": baselines.baseline_report(bounds, "weekbaseline"),
        "verdicts": baselines.judge_flows(day, bounds),
    }


def flow_baseline(day: DataFrame, week: DataFrame) -> DataFrame:
    """Verdicts of a day's flows against the week's bounds."""
    return baselines.judge_flows(day, baselines.week_baseline(week))


def repeated_flows(flows: DataFrame) -> DataFrame:
    """Incoming flows that are not the first of their time, ends and protocol."""
    keys = ["recordtime", "srcip", "dstip", "proto"]
    marked = joins.with_group_stats(flows, keys, "row", first_row=F.min("row"))
    return marked.where((F.col("row") > F.col("first_row")) & (F.col("flowd") == ff.OUT_TO_IN)).drop("first_row")


def attacks_of(classified: DataFrame, more_than: int = 10) -> DataFrame:
    """Attack rows of classified flows: named type and more than ten flows of the same time, ends and protocol."""
    hits = stored(classified.where("prediction > 0"), "hits")  # the model's hits are counted and listed
    sized = joins.with_group_size(hits, ["srcip", "dstip", "proto", "recordtime"])
    kind = ff.attack_type(F.col("prediction"), F.col("proto"), F.col("packernum"))
    named = sized.withColumn("attacktype", kind)
    return named.where((F.col("attacktype") != "") & (F.col("flownums") > more_than))


def flow_attacks(flows: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Attack summary of repeated incoming flows; ``flows`` carries its class unless a model is given."""
    targets = repeated_flows(flows)
    if model is not None:
        hot = ff.one_hot(F.col("proto"), ff.FLOW_PROTOCOLS)
        targets = models.forest_predict(model, targets.drop("prediction").withColumns(hot).withColumn("spandtime", F.col("costtime")))
    return agg.attack_summary(attacks_of(targets))


# -- audit and assets ----------------------------------------------------------------------------------------------


def sql_audit(logs: DataFrame) -> DataFrame:
    return audit.audit_reach(logs)


def new_asset_report(flows: DataFrame, register: DataFrame, found: DataFrame, ranges: list[tuple[str, str]]) -> DataFrame:
    """New addresses from both ends of the flows, told apart by ``side``."""
    known = assets.known_assets(register, found)
    src = assets.new_assets(assets.source_candidates(flows, known, ranges), "src")
    dst = assets.new_assets(assets.destination_candidates(flows, known, ranges), "dst")
    return src.withColumn("side", F.lit("src")).unionByName(dst.withColumn("side", F.lit("dst")))


def url_attacks(moniflow: DataFrame, model: PipelineModel) -> DataFrame:
    """Attacks among inbound URLs by a stored model, both predictions with their probabilities."""
    inbound = moniflow.where(F.col("flowd") == ff.OUT_TO_IN)
    return models.url_attacks(model, tokenize_uris(inbound.select("id", "date", "srcip", "dstip", "uri"))).select(
        "id", "date", "srcip", "dstip", "uri", "prediction_nb", "probability_nb", "prediction_lr", "probability_lr")


# -- two-level portrait --------------------------------------------------------------------------------------------


def portrait_level_one(flows: DataFrame, k: int = 3) -> DataFrame:
    """Flows of every monitored asset clustered inside the asset; clusters of up to two rows become 'other'."""
    ends = F.array_distinct(F.array("srcip", "dstip"))
    monitored = agg.own_side(flows, ()).select("ip").unionByName(
        flows.where(F.col("flowd") == ff.IN_TO_IN).select(F.col("dstip").alias("ip"))
    ).distinct()
    features = ["costtime", "tcp", "udp", "icmp", "gre", "packernum", "bytesize"]
    # what the portrait reads of a flow
    rows = flows.select("row", "srcport", "dstport", "recordtime", *features, F.explode(ends).alias("ip"))
    labelled = clustering.grouped_kmeans(rows, ["ip"], "row", features, k, scaled=True, only=monitored)
    name = F.when(F.col("cluster_size") > 2, F.col("label").cast("string")).otherwise("other")
    return labelled.withColumn("prediction", name).drop("label")


def portrait_level_two(level_one: DataFrame, moniflow: DataFrame, k: int = 3) -> DataFrame:
    """Audit rows of each level-one cluster clustered again, inside (asset, parent cluster)."""
    audit_rows = moniflow.select("id", "srcport", "dstport", "appproto", "method", F.explode(F.array_distinct(F.array("srcip", "dstip"))).alias("ip"))
    matched = joins.flows_to_audit(level_one.where(F.col("prediction") != "other"), audit_rows)
    hot = ff.one_hot(F.col("appproto"), ff.APP_PROTOCOLS, False)
    rows = matched.withColumns(hot).withColumnRenamed("prediction", "parent")
    group = ["ip", "parent"]
    guarded = lambda n: F.when(n <= 2, 1).when(n <= k, n - 1).otherwise(k)
    return clustering.grouped_kmeans(rows, group, "id", list(APP_FEATURES), k, weight="n_flows", allowed=guarded, scaled=True)


def portrait_centers(level_one: DataFrame, level_two: DataFrame) -> DataFrame:
    """Center of every cluster of both levels: dominant protocol, then the truncated other means; parent kept."""
    protos = [p.lower() for p in ff.FLOW_PROTOCOLS]
    one = level_one.where(F.col("prediction") != "other").groupBy("ip", "prediction").agg(
        *[F.avg(f).alias(f) for f in ("costtime", *protos, "packernum", "bytesize")], F.count(F.lit(1)).alias("members")
    )
    head = ff.dominant_feature([F.col(p) for p in protos], list(ff.FLOW_PROTOCOLS))
    rest = [ff.truncated(F.round(f, 6)).cast("string") for f in ("costtime", "packernum", "bytesize")]
    first = one.select(
        F.lit("1").alias("type"), "ip", F.lit("").alias("parent"), F.col("prediction").alias("label"),
        F.concat_ws("#", head, *rest).alias("center"), "members",
    )
    w = F.col("n_flows")
    two = level_two.groupBy("ip", "parent", "label").agg(
        *[(F.sum(F.col(f) * w) / F.sum(w)).alias(f) for f in APP_FEATURES], F.sum(w).alias("members")
    )
    second = two.select(
        F.lit("2").alias("type"), "ip", "parent", F.col("label").cast("string").alias("label"),
        ff.dominant_feature([F.col(f) for f in APP_FEATURES], list(ff.APP_PROTOCOLS)).alias("center"), "members",
    )
    return first.unionByName(second)


def portrait_points(level_one: DataFrame, level_two: DataFrame) -> DataFrame:
    """Cluster points of both levels: flows with their protocol, sums and time, audit rows with protocol and method."""
    protos = [p.lower() for p in ff.FLOW_PROTOCOLS]
    head = ff.dominant_feature([F.col(p) for p in protos], list(ff.FLOW_PROTOCOLS))
    parts = [F.col(f).cast("string") for f in ("costtime", "packernum", "bytesize")]
    first = level_one.select(
        F.lit("1").alias("type"), "ip", F.lit("").alias("parent"), F.col("prediction").alias("label"), F.col("row").cast("string").alias("point"),
        F.concat_ws("#", head, *parts, ff.time_text(F.col("recordtime"))).alias("info"), "distance",
    )
    kind = ff.dominant_feature([F.col(f) for f in APP_FEATURES], list(ff.APP_PROTOCOLS))
    second = level_two.select(
        F.lit("2").alias("type"), "ip", "parent", F.col("label").cast("string").alias("label"), F.col("id").cast("string").alias("point"),
        F.concat_ws("#", kind, "method").alias("info"), "distance",
    )
    return first.unionByName(second)


def asset_portrait_tables(flows: DataFrame, moniflow: DataFrame) -> dict[str, DataFrame]:
    """Published tables of the two-level portrait of every monitored asset: centers and points of both levels."""
    one = portrait_level_one(flows)
    two = portrait_level_two(one, moniflow)
    return {"centers": portrait_centers(one, two), "points": portrait_points(one, two)}


def asset_portrait(flows: DataFrame, moniflow: DataFrame) -> DataFrame:
    """Centers of the two-level portrait of every monitored asset."""
    return asset_portrait_tables(flows, moniflow)["centers"]
