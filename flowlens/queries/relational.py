"""Joins, aggregations, windows, order and set operators."""

from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.operators import aggregates as agg
from flowlens.operators import assets, audit, baselines, clustering, groups, indexing, joins, ports
from flowlens.operators.similarity import user_similarity
from flowlens.plans import jobs
from flowlens.queries.parts import SEVEN, half_up, part
from flowlens.queries.registry import query
from flowlens.session import stored
from flowlens.sources import fixtures as fx
from flowlens.sources import readers

# -- joins -------------------------------------------------------------------------------------------------------------


@query("join_index_to_name", 'SELECT ip, host, "count" FROM ratings', "ratings")
def join_index_to_name(spark, d):
    """Ratings by index, named again: the indexes stay inside."""
    indexed = stored(indexing.index_users_items(stored(fx.ratings(spark, d), "ratings")), "indexed")
    bare = indexed.select("ip_index", "host_index", "count")
    return joins.names_for_indexes(bare, indexed, indexed).select("ip", "host", "count")


part("norms", 'SELECT ip, sqrt(sum("count" * "count")) AS n FROM ratings GROUP BY ip', "ratings")
part("user_pairs", """
SELECT ip1, ip2, round(s, 3) AS sim FROM (
  SELECT a.ip AS ip1, b.ip AS ip2, sum(a."count" * b."count" / (na.n * nb.n)) AS s
  FROM ratings a JOIN ratings b ON a.host = b.host AND a.ip < b.ip JOIN norms na ON na.ip = a.ip JOIN norms nb ON nb.ip = b.ip
  GROUP BY a.ip, b.ip) WHERE s >= 0.7 - 1e-12""", "ratings", "norms")


@query("join_similarity_reason", """
SELECT s.ip1, s.ip2, a.host, s.sim, a."count" AS ip1_count, b."count" AS ip2_count, round(a."count" / b."count", 6) AS rate
FROM user_pairs s JOIN ratings a ON a.ip = s.ip1 JOIN ratings b ON b.ip = s.ip2 AND b.host = a.host""", ("ratings", "user_pairs"))
def join_similarity_reason(spark, d):
    rated = fx.ratings(spark, d)
    pairs = user_similarity(rated).withColumnsRenamed({"left": "ip1", "right": "ip2"})
    return joins.similarity_reasons(pairs, rated).withColumn("rate", F.round("rate", 6))


@query("join_reverse_flow", 'SELECT "row", srcip, dstip, srcport, dstport, costtime, packernum, bytesize FROM merged', "merged")
def join_reverse_flow(spark, d):
    return joins.merge_reverse_flows(fx.port_flows(spark, d)).select(
        "row", "srcip", "dstip", "srcport", "dstport", "costtime", "packernum", "bytesize"
    )


AUDITED = """
SELECT DISTINCT e."row", e.sourceip, e.destip, e.firstrecvtime, e.eventname, e.orglog,
       CASE WHEN contains(g.orglog, 'sql') AND e.firstrecvtime - g.firstrecvtime < 1000
                 AND e.firstrecvtime - g.firstrecvtime > -1000 THEN '1' ELSE '0' END AS reach
FROM genlog e LEFT JOIN genlog g ON e."row" <> g."row" AND e.sourceip = g.sourceip AND e.destip = g.destip
WHERE e.eventname = 'HTTP_SQL注入攻击' OR e.eventname LIKE 'SQL Injection%'"""


@query("join_audit_theta", f"""
SELECT "row", sourceip, destip, eventname, string_agg(reach, ',' ORDER BY reach) AS reaches FROM ({AUDITED}) GROUP BY 1, 2, 3, 4""", "genlog")
def join_audit_theta(spark, d):
    """Outcome of the event-to-log theta join per event, from counts per address pair instead of row pairs."""
    reached = audit.audit_reach(fx.genlog(spark, d))
    # an event has at most two verdicts
    both = F.array_join(F.array_sort(F.collect_set("reach")), ",")
    return reached.groupBy("row", "sourceip", "destip", "eventname").agg(both.alias("reaches"))


@query("join_group_count_back", """
SELECT "row", srcip, dstip, proto, count(*) OVER (PARTITION BY srcip, dstip, proto, recordtime) AS flownums FROM flows""", "flows")
def join_group_count_back(spark, d):
    sized = joins.with_group_size(fx.flows(spark, d), ["srcip", "dstip", "proto", "recordtime"])
    return sized.select("row", "srcip", "dstip", "proto", "flownums")


@query("join_flow_to_audit", """
SELECT m.id, m.srcip AS ip, m.srcport, m.dstport, m.appproto, m.host, f.prediction, f.n_flows
FROM moniflow m JOIN (SELECT srcip AS ip, srcport, dstport, CAST(CAST(prediction AS INT) AS VARCHAR) AS prediction, count(*) AS n_flows
  FROM flows GROUP BY ALL) f ON f.ip = m.srcip AND f.srcport = m.srcport AND f.dstport = m.dstport""", ("moniflow", "flows"))
def join_flow_to_audit(spark, d):
    flows = fx.flows(spark, d).select(
        F.col("srcip").alias("ip"), "srcport", "dstport", F.col("prediction").cast("int").cast("string").alias("prediction")
    )
    rows = fx.moniflow(spark, d).select("id", F.col("srcip").alias("ip"), "srcport", "dstport", "appproto", "host")
    return joins.flows_to_audit(flows, rows)


_NEW = """
SELECT {ip} AS ip, '{side}' AS side, strftime(recordtime, '%Y-%m-%d %H:%M:%S') AS storagetime, 1 AS isnew, 0 AS flg, max(proto) AS protocol,
       max({port}) AS port, max(packernum) AS packagenum
FROM (SELECT *, rank() OVER (PARTITION BY {ip} ORDER BY recordtime DESC) AS r FROM flows
      WHERE (split_part({ip}, '.', 2) = '0' OR (split_part({ip}, '.', 2) = '1' AND split_part({ip}, '.', 3) = '0')) AND {cond} AND {ip} NOT IN (SELECT ip FROM known)) WHERE r = 1 GROUP BY {ip}, recordtime"""
NEW_ASSETS = _NEW.format(ip="srcip", side="src", port="srcport", cond="proto <> 'ICMP'") + "\nUNION ALL" + _NEW.format(
    ip="dstip", side="dst", port="dstport", cond="proto = 'TCP' AND packernum > 2"
)


@query("join_latest_record", """
SELECT srcip AS ip, strftime(recordtime, '%Y-%m-%d %H:%M:%S') AS storagetime, max(proto) AS protocol, max(srcport) AS port, max(packernum) AS packagenum
FROM (SELECT *, rank() OVER (PARTITION BY srcip ORDER BY recordtime DESC) AS r FROM flows) WHERE r = 1 GROUP BY srcip, recordtime""", "flows")
def join_latest_record(spark, d):
    latest = joins.latest_records(
        fx.flows(spark, d), "srcip", "recordtime", protocol=F.col("proto"), port=F.col("srcport"), packagenum=F.col("packernum")
    )
    return latest.withColumn("storagetime", ff.time_text(F.col("storagetime")))


@query("semi_join_in", 'SELECT "row", srcip FROM flows WHERE srcip IN (SELECT ip FROM known)', ("flows", "known"))
def semi_join_in(spark, d):
    known = assets.known_assets(fx.asset_register(spark, d), fx.assets_found(spark, d))
    return joins.keep_listed(fx.flows(spark, d).select("row", "srcip"), known, "srcip")


part("outlier_ips", "SELECT DISTINCT ip FROM labelled WHERE label LIKE 'other%'", "labelled")


@query("anti_join_subtract", "SELECT ip, round(proto, 6) AS proto FROM scored WHERE ip NOT IN (SELECT ip FROM outlier_ips)", ("scored", "outlier_ips"))
def anti_join_subtract(spark, d):
    scored = jobs.scored_assets(fx.flows_wide(spark, d))
    outliers = groups.quadrant_labels(scored).where(F.col("label").isin(*groups.OUTLIER_LABELS)).select(F.col("ip").alias("out_ip"))
    kept = joins.drop_listed(scored, outliers, "ip", "out_ip")
    return kept.select("ip", F.round("proto", 6).alias("proto"))


@query("anti_join_known_assets", 'SELECT "row", srcip FROM flows WHERE srcip NOT IN (SELECT ip FROM known)', ("flows", "known"))
def anti_join_known_assets(spark, d):
    known = assets.known_assets(fx.asset_register(spark, d), fx.assets_found(spark, d))
    return joins.drop_listed(fx.flows(spark, d).select("row", "srcip"), known, "srcip")


part("last_own", """
SELECT CASE WHEN flowd IN ('0', '2') THEN srcip ELSE dstip END AS ip, tcp, udp, packernum, bytesize
FROM flows_wide WHERE flowd IN ('0', '1', '2') AND recordtime <= TIMESTAMP '2000-12-31 23:59:59'""", "flows_wide")
_FOUR = ("tcp", "udp", "packernum", "bytesize")
part("last_scored", "SELECT ip, 0.25::DOUBLE * tcp + 0.25::DOUBLE * udp AS proto, 0.33::DOUBLE * packernum + 0.33::DOUBLE * bytesize AS flow FROM (SELECT ip, "
     + ", ".join(f"CASE WHEN max({f}) OVER () = min({f}) OVER () THEN 0.5 ELSE CAST({f} - min({f}) OVER () AS DOUBLE) / (max({f}) OVER () - min({f}) OVER ()) END AS {f}" for f in _FOUR)
     + " FROM (SELECT ip, " + ", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}" for f in _FOUR) + " FROM last_own GROUP BY ip))", "last_own")
part("last_bounds", "SELECT avg(proto) AS p, avg(flow) AS f, avg(proto) + 3 * stddev_pop(proto) AS p_hi, avg(flow) + 3 * stddev_pop(flow) AS f_hi FROM last_scored", "last_scored")
part("last_labels", """
SELECT ip, 'other_high_proto' AS label FROM last_scored, last_bounds WHERE proto > p_hi
UNION ALL SELECT ip, 'other_high_flow' FROM last_scored, last_bounds WHERE flow > f_hi
UNION ALL SELECT ip, concat(CASE WHEN proto > p THEN 'high' ELSE 'low' END, '_', CASE WHEN flow > f THEN 'high' ELSE 'low' END)
FROM last_scored, last_bounds WHERE NOT (proto > p_hi OR flow > f_hi)""", "last_scored", "last_bounds")


def last_labels(spark, d):
    """Labels of a run over the history, with four features."""
    before = readers.in_time_range(fx.flows_wide(spark, d), "recordtime", *fx.HISTORY)
    return groups.quadrant_labels(jobs.scored_assets(before, agg.FOUR_FEATURES)).select("ip", "label")


@query("join_last_result", """
SELECT DISTINCT l.ip, l.label, p.label AS last_label, CAST(l.label IS DISTINCT FROM p.label AS INT) AS changed,
       CASE WHEN l.label IS DISTINCT FROM p.label THEN '1' ELSE '0' END AS same_is_zero,
       CASE WHEN l.label IS DISTINCT FROM p.label THEN '0' ELSE '1' END AS same_is_one
FROM labelled l LEFT JOIN last_labels p ON l.ip = p.ip""", ("labelled", "last_labels"))
def join_last_result(spark, d):
    now = groups.quadrant_labels(jobs.scored_assets(fx.flows_wide(spark, d))).select("ip", "label")
    joined = joins.with_last_result(now, last_labels(spark, d))
    return joined.select(
        "ip", "label", "last_label", F.col("changed").cast("int").alias("changed"),
        joins.changed_flag(False).alias("same_is_zero"), joins.changed_flag(True).alias("same_is_one"),
    )


@query("join_baseline", """
SELECT f."row", f.srcip, f.proto, f.hour, round(w.connectup, 6) AS connectup, round(w.netflowup, 6) AS netflowup
FROM current_flows f LEFT JOIN history_week w ON w.baseline = 'proto' AND w.name = f.srcip AND w.proto = f.proto AND w.hour = f.hour""", ("current_flows", "history_week"))
def join_baseline(spark, d):
    day, week = split_flows(spark, d)
    bounds = baselines.week_baseline(week).where("baseline = 'proto'").select(
        F.col("name").alias("srcip"), "proto", "hour", F.round("connectup", 6).alias("connectup"), F.round("netflowup", 6).alias("netflowup")
    )
    keys = ["srcip", "proto", "hour"]
    return joins.with_baseline(day.select("row", *keys), bounds, keys)


def split_flows(spark, d):
    """(current, history) flows by record time."""
    flows = fx.flows(spark, d)
    span = lambda w: readers.in_time_range(flows, "recordtime", *w)
    return span(fx.CURRENT), span(fx.HISTORY)


@query("join_rating_prediction")
def join_rating_prediction(spark, d):
    from flowlens.operators import models

    indexed = indexing.index_users_items(stored(fx.ratings(spark, d), "ratings")).cache()
    model = models.als_fit(indexed)
    return model.transform(indexed).select("ip", "host", "count", "prediction")


part("point_cells0", "SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM points", "points")


@query("join_center_lookup", """
SELECT vec_id, p.label, round(sum(x * c), 6) AS product, round(sum(c * c), 6) AS center_square FROM point_cells0 p
JOIN (SELECT label, i, avg(x) AS c FROM point_cells0 GROUP BY label, i) c ON c.label = p.label AND c.i = p.i GROUP BY vec_id, p.label""", "point_cells0")
def join_center_lookup(spark, d):
    points = fx.embedding_points(spark, d)
    joined = joins.with_centers(points, clustering.vector_centers(points))

    def product(a, b):
        return F.round(F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), 6)

    return joined.select("vec_id", "label", product("v", "center").alias("product"), product("center", "center").alias("center_square"))


part("host_members", "SELECT DISTINCT ip, host, length(ip) % 3 AS label FROM ratings", "ratings")
part("host_top", """
SELECT label, string_agg(host, '#' ORDER BY n DESC, host) AS top_hosts FROM (
  SELECT label, host, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, host) AS r
  FROM (SELECT label, host, count(*) AS n FROM host_members GROUP BY label, host)) WHERE r <= 10 GROUP BY label""", "host_members")


def _top_hosts(spark, d):
    members = fx.ratings(spark, d).select("ip", "host", (F.length("ip") % 3).alias("label"))
    counted = members.groupBy("label", "host").agg(F.count(F.lit(1)).alias("n"))
    return members, agg.top_per_group(counted, "label", [F.desc("n"), F.asc("host")], 10)


@query("join_cluster_top_hosts", "SELECT DISTINCT m.ip, m.label, t.top_hosts FROM host_members m LEFT JOIN host_top t ON t.label = m.label", ("host_members", "host_top"))
def join_cluster_top_hosts(spark, d):
    members, top = _top_hosts(spark, d)
    return joins.members_with_top_hosts(members.select("ip", "label").distinct(), agg.joined_text(top, "label", "host")).select("ip", "label", "top_hosts")


# -- aggregations ------------------------------------------------------------------------------------------------------


@query("agg_ip_totals", f"SELECT ip, {', '.join(SEVEN)} FROM totals", "totals")
def agg_ip_totals(spark, d):
    return agg.ip_totals(agg.own_side(fx.flows_wide(spark, d)))


VISITS = """
SELECT CASE WHEN grouping(time) = 0 THEN 'ip_host_time' ELSE 'ip_host' END AS level, ip, host,
       CASE WHEN grouping(time) = 0 THEN time END AS time, count(host) AS "count"
FROM visits GROUP BY GROUPING SETS ((ip, host, time), (ip, host))"""


@query("agg_ip_host_time", f"SELECT ip, host, time, \"count\" FROM ({VISITS}) WHERE level = 'ip_host_time'", "visits")
def agg_ip_host_time(spark, d):
    return agg.visit_counts(jobs.visits(fx.moniflow(spark, d))).where("level = 'ip_host_time'").drop("level")


@query("agg_ip_host", f"SELECT ip, host, \"count\" FROM ({VISITS}) WHERE level = 'ip_host'", "visits")
def agg_ip_host(spark, d):
    return agg.visit_counts(jobs.visits(fx.moniflow(spark, d))).where("level = 'ip_host'").drop("level", "time")


SESSIONS = """
SELECT strftime(recordtime, '%Y-%m-%d %H:%M:%S') AS recordtime, srcip, dstip, proto, CAST(sum(costtime) AS BIGINT) AS costtime,
       CAST(sum(packernum) AS BIGINT) AS packernum, CAST(sum(bytesize) AS BIGINT) AS bytesize, count(*) AS flownuma,
       count(DISTINCT srcport) AS flownums, count(DISTINCT dstport) AS flownumd,
       array_to_string(list_sort(list(DISTINCT srcport)), ',') AS srcports, array_to_string(list_sort(list(DISTINCT dstport)), ',') AS dstports
FROM flows GROUP BY flows.recordtime, srcip, dstip, proto"""


@query("agg_flow_session", SESSIONS, "flows")
def agg_flow_session(spark, d):
    return agg.flow_sessions(fx.flows(spark, d)).withColumn("recordtime", ff.time_text(F.col("recordtime")))


def day(name: str, source: str) -> None:
    part(name, f"""
SELECT srcip AS name, CASE WHEN grouping(proto) = 0 THEN proto ELSE '' END AS proto, hour, CAST(max(packernum) AS DOUBLE) AS connectavg,
       round(max(bytesize) / 1024.0, 6) AS netflowavg, CASE WHEN grouping(proto) = 0 THEN 'proto' ELSE 'all' END AS baseline
FROM {source} GROUP BY GROUPING SETS ((srcip, proto, hour), (srcip, hour))""", source)


day("day", "flows")


@query("agg_day_baseline", "SELECT * FROM day", "day")
def agg_day_baseline(spark, d):
    return baselines.day_baseline(fx.flows(spark, d)).withColumn("netflowavg", F.round("netflowavg", 6))


@query("agg_week_baseline", "SELECT name, proto, hour, round(connectup, 6) AS connectup, round(netflowup, 6) AS netflowup, baseline FROM week", "week")
def agg_week_baseline(spark, d):
    out = baselines.week_baseline(fx.flows(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("connectup", "netflowup")})


@query("agg_port_baseline_3sigma", "SELECT * FROM classified_simple_sigma", "classified_simple_sigma")
def agg_port_baseline_3sigma(spark, d):
    return ports.port_baseline_3sigma(ports.classify_ports_simple(fx.port_flows(spark, d)))


def largest(name: str) -> None:
    """Four-level maxima of a classified table, as ``<name>_max``; needs its open lists."""
    part(f"{name}_max0", f"""
SELECT name, CASE WHEN grouping(port) = 0 THEN port ELSE '' END AS port, CASE WHEN grouping(proto) = 0 THEN proto ELSE '' END AS proto,
       CAST(hour AS VARCHAR) AS hour, CAST(max(packernum) AS DOUBLE) AS connectavg, {half_up('max(bytesize) / 1024.0')} AS netflowavg,
       CASE WHEN grouping(port) = 0 AND grouping(proto) = 0 THEN 'PORTPROTO' WHEN grouping(port) = 0 THEN 'PORT'
            WHEN grouping(proto) = 0 THEN 'PROTO' ELSE 'ALL' END AS baseline
FROM {name} GROUP BY GROUPING SETS ((name, hour), (name, port, hour), (name, proto, hour), (name, port, proto, hour))""", name)
    part(f"{name}_max", f"""
SELECT * FROM {name}_max0 l
WHERE (baseline IN ('ALL', 'PROTO') OR EXISTS (SELECT 1 FROM {name}_open_ports o WHERE o.name = l.name AND o.port = l.port))
  AND (baseline IN ('ALL', 'PORT') OR EXISTS (SELECT 1 FROM {name}_open_protos o WHERE o.name = l.name AND o.proto = l.proto))""",
         f"{name}_max0", f"{name}_open_ports", f"{name}_open_protos")


largest("classified")


@query("agg_port_baseline_max", "SELECT * FROM classified_max", "classified_max")
def agg_port_baseline_max(spark, d):
    return ports.port_baseline_max(ports.classify_ports(fx.port_flows(spark, d)))


@query("agg_port_baseline_3mean", """
SELECT name, port, proto, CAST(0 AS DOUBLE) AS connectdown, connectup, CAST(0 AS DOUBLE) AS netflowdown, netflowup, baseline FROM classified_mean""", "classified_mean")
def agg_port_baseline_3mean(spark, d):
    return ports.port_baseline_3mean(ports.classify_ports(fx.port_flows(spark, d)))


@query("agg_rare_ports", """
SELECT dstip, dstport, count(dstport) AS hits, CAST(count(dstport) < 30 AS INT) AS rare_fixed,
       CAST(count(dstport) < (SELECT greatest(10, CAST(floor(count(*) * 0.00375::DOUBLE) AS BIGINT)) FROM port_flows) AS INT) AS rare_share
FROM port_flows GROUP BY dstip, dstport
HAVING count(dstport) < greatest(30, (SELECT greatest(10, CAST(floor(count(*) * 0.00375::DOUBLE) AS BIGINT)) FROM port_flows))""", "port_flows")
def agg_rare_ports(spark, d):
    flows = fx.port_flows(spark, d)
    share = ports.rare_threshold(flows)
    rare = ports.rare_ports(flows, F.greatest(F.lit(ports.RARE_FIXED), share))
    return rare.withColumns(
        {"rare_fixed": (F.col("hits") < ports.RARE_FIXED).cast("int"), "rare_share": (F.col("hits") < share).cast("int")}
    )


@query("agg_cluster_size_filter", """
SELECT label, count(*) AS cluster_size, CAST(count(*) < 2 AS INT) AS outlier FROM points GROUP BY label HAVING count(*) > 2 OR count(*) < 2""", "points")
def agg_cluster_size_filter(spark, d):
    sizes = agg.cluster_sizes(fx.embedding_points(spark, d))
    n = F.col("cluster_size")
    return sizes.where((n > 2) | (n < 2)).withColumn("outlier", (n < 2).cast("int"))


part("hl_points", "SELECT *, CASE WHEN label LIKE 'other%' THEN 'other' ELSE label END AS cluster FROM labelled", "labelled")


@query("agg_cluster_center", "SELECT cluster AS label, CASE WHEN cluster = 'other' THEN '-1' ELSE concat_ws('#', "
       + ", ".join(f"CAST(floor(round(avg({f}), 6)) AS BIGINT)" for f in SEVEN) + ") END AS center FROM hl_points GROUP BY cluster", "hl_points")
def agg_cluster_center(spark, d):
    """Truncated means of every cluster; the outlier cluster is published with a sentinel."""
    labelled = groups.quadrant_labels(jobs.scored_assets(fx.flows_wide(spark, d)))
    outlier = F.col("label").isin(*groups.OUTLIER_LABELS)
    points = labelled.withColumn("label", F.when(outlier, "other").otherwise(F.col("label")))
    return groups.truncated_center(agg.cluster_centers(points, SEVEN), SEVEN).select("label", "center")


@query("agg_global_moments", "SELECT " + ", ".join(
    f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std, round(max({c}), 6) AS {c}_max" for c in ("proto", "flow")
) + " FROM scored", "scored")
def agg_global_moments(spark, d):
    out = agg.moments(jobs.scored_assets(fx.flows_wide(spark, d)), ["proto", "flow"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("agg_baskets", "SELECT ip, hour, host, count(*) AS visits FROM visits GROUP BY ip, hour, host", "visits")
def agg_baskets(spark, d):
    return agg.baskets(jobs.visits(fx.moniflow(spark, d)))


part("sized", 'SELECT *, count(*) OVER (PARTITION BY srcip, dstip, proto, recordtime) AS flownums FROM flows WHERE prediction > 0', "flows")
_KIND = ("CASE WHEN prediction = 1 AND proto = 'TCP' THEN 'CC' WHEN prediction IN (2, 3) AND proto = 'UDP' THEN 'UDPFlood' "
         "WHEN prediction IN (2, 3) AND proto = 'TCP' THEN 'SYNFlood' WHEN prediction = 4 AND packernum = 1 THEN 'PORTSCAN' ELSE '' END")


@query("agg_attack_summary", f"""
SELECT attacktype, srcip, dstip, proto, srcport, dstport, strftime(recordtime, '%Y-%m-%d %H:%M:%S') AS recordtime, flownums, count(*) AS flownuma
FROM (SELECT *, {_KIND} AS attacktype FROM sized) s WHERE attacktype <> '' AND flownums > 10
GROUP BY attacktype, srcip, dstip, proto, srcport, dstport, s.recordtime, flownums""", "sized")
def agg_attack_summary(spark, d):
    out = agg.attack_summary(jobs.attacks_of(fx.flows(spark, d)))
    return out.withColumn("recordtime", ff.time_text(F.col("recordtime")))


part("two_models", """
SELECT quality AS label, CASE WHEN n_chars % 3 = 0 THEN 1 - quality ELSE quality END AS prediction_nb,
       CASE WHEN n_chars % 5 = 0 THEN 1 - quality ELSE quality END AS prediction_lr FROM documents JOIN labels USING (doc_id)""")


def _two_models(spark, d):
    rows = fx.table(spark, d, "documents").select("doc_id", "n_chars").join(fx.table(spark, d, "labels"), "doc_id")
    flip = lambda n: F.when(F.col("n_chars") % n == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return rows.select(F.col("quality").alias("label"), flip(3).alias("prediction_nb"), flip(5).alias("prediction_lr"))


def _cells(model: str) -> str:
    counts = ", ".join(
        f"count(*) FILTER (label = {a} AND prediction_{model} = {p}) AS {n}" for n, a, p in (("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0))
    )
    return f"SELECT '{model}' AS model, {counts} FROM two_models"


def _cell(n: str, predicted: str, actual: str) -> str:
    return f"concat({n}, '||precision:', printf('%.3f', 100.0::DOUBLE * {n} / ({predicted})), '% recall:', printf('%.3f', 100.0::DOUBLE * {n} / ({actual})), '%')"


@query("agg_confusion_matrix", "SELECT model, "
       + f"{_cell('tp', 'tp + fp', 'tp + fn')} AS actual1_predicted1, {_cell('fn', 'tn + fn', 'tp + fn')} AS actual1_predicted0, "
       + f"{_cell('fp', 'tp + fp', 'fp + tn')} AS actual0_predicted1, {_cell('tn', 'tn + fn', 'fp + tn')} AS actual0_predicted0 "
       + f"FROM ({_cells('nb')} UNION ALL {_cells('lr')})", "two_models")
def agg_confusion_matrix(spark, d):
    return agg.confusion_report(agg.confusion_counts(_two_models(spark, d)))


@query("agg_accuracy", "SELECT count(*) AS n, round(100 * avg(CASE WHEN label = prediction_nb THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM two_models", "two_models")
def agg_accuracy(spark, d):
    return agg.accuracy(_two_models(spark, d), "label", "prediction_nb").withColumn("accuracy", F.round("accuracy", 6))


@query("distinct_values", """
SELECT DISTINCT 'srcip' AS kind, srcip AS v FROM flows UNION ALL SELECT DISTINCT 'dstport', CAST(dstport AS VARCHAR) FROM flows
UNION ALL SELECT DISTINCT 'proto', proto FROM flows""", "flows")
def distinct_values(spark, d):
    """Distinct lists of three columns in one scan and one pre-aggregated shuffle."""
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("v")) for k in ("srcip", "dstport", "proto")]
    return fx.flows(spark, d).select(F.inline(F.array(*kinds))).distinct()


@query("agg_half_count", 'SELECT ip, host, count(host) / 2.0 AS "count" FROM (SELECT * FROM visits UNION ALL SELECT * FROM visits) GROUP BY ip, host HAVING count(host) > 0', "visits")
def agg_half_count(spark, d):
    """The plain count: half of the count over the doubled input."""
    visits = jobs.visits(fx.moniflow(spark, d))
    return visits.groupBy("ip", "host").agg(F.count("host").cast("double").alias("count"))


@query("agg_median_label", """
SELECT ip, CAST(CASE WHEN proto > (SELECT median(proto) FROM scored) THEN 2 ELSE 0 END
     + CASE WHEN flow > (SELECT median(flow) FROM scored) THEN 1 ELSE 0 END AS VARCHAR) AS tag FROM scored""", "scored")
def agg_median_label(spark, d):
    return agg.median_labels(jobs.scored_assets(fx.flows_wide(spark, d))).select("ip", "tag")


@query("crosstab", "SELECT proto, flowd, count(*) AS n FROM flows GROUP BY proto, flowd", "flows")
def crosstab(spark, d):
    return agg.crosstab(fx.flows(spark, d), "proto", "flowd")


# -- windows -----------------------------------------------------------------------------------------------------------

part("repeats", """
SELECT * FROM (SELECT *, min("row") OVER (PARTITION BY recordtime, srcip, dstip, proto) AS first_row FROM flows)
WHERE "row" > first_row AND flowd = '1'""", "flows")


@query("win_repeat_flow", 'SELECT "row", srcip, dstip, proto FROM repeats', "repeats")
def win_repeat_flow(spark, d):
    return jobs.repeated_flows(fx.flows(spark, d)).select("row", "srcip", "dstip", "proto")


@query("win_group_size", """
SELECT "row", proto, count(*) OVER (PARTITION BY srcip, dstip, proto, recordtime) AS flownums FROM repeats""", "repeats")
def win_group_size(spark, d):
    repeated = stored(jobs.repeated_flows(fx.flows(spark, d)), "repeated")  # counted and listed
    sized = joins.with_group_size(repeated, ["srcip", "dstip", "proto", "recordtime"])
    return sized.select("row", "proto", "flownums")


# -- order and limits --------------------------------------------------------------------------------------------------


@query("sort_multi_key", 'SELECT "row", srcip, dstip, proto FROM flows ORDER BY recordtime, srcip, dstip, proto, "row"', "flows")
def sort_multi_key(spark, d):
    ordered = fx.flows(spark, d).orderBy("recordtime", "srcip", "dstip", "proto", "row")
    return ordered.select("row", "srcip", "dstip", "proto")


@query("sort_desc_score", "SELECT ip, round(proto + flow, 6) AS score FROM scored ORDER BY score DESC, ip", "scored")
def sort_desc_score(spark, d):
    scored = jobs.scored_assets(fx.flows_wide(spark, d))
    return scored.select("ip", F.round(F.col("proto") + F.col("flow"), 6).alias("score")).orderBy(F.desc("score"), "ip")


@query("topk_hosts_per_cluster", "SELECT label, top_hosts FROM host_top", "host_top")
def topk_hosts_per_cluster(spark, d):
    return agg.joined_text(_top_hosts(spark, d)[1], "label", "host")


@query("limit_rows", 'SELECT "row", srcip, dstip FROM flows ORDER BY "row" LIMIT 1000', "flows")
def limit_rows(spark, d):
    """First thousand rows in key order: a top-n report."""
    return fx.flows(spark, d).select("row", "srcip", "dstip").orderBy("row").limit(1000)


# -- set operators -----------------------------------------------------------------------------------------------------


@query("union_all", 'SELECT srcip AS ip, \'src\' AS side FROM flows UNION ALL SELECT dstip, \'dst\' FROM flows', "flows")
def union_all(spark, d):
    flows = fx.flows(spark, d)
    return joins.union_all([
        flows.select(F.col("srcip").alias("ip"), F.lit("src").alias("side")),
        flows.select(F.col("dstip").alias("ip"), F.lit("dst").alias("side")),
    ])


@query("subtract", """
SELECT srcip, srcport, hour FROM flows f
WHERE NOT EXISTS (SELECT 1 FROM flows g WHERE g.proto = 'GRE' AND g.dstip = f.srcip AND g.dstport = f.srcport AND g.hour = f.hour)""", "flows")
def subtract(spark, d):
    """Sources that were no destination of a tunnel in the same hour: every copy of a found value goes."""
    flows = fx.flows(spark, d)
    found = flows.where("proto = 'GRE'").select("dstip", "dstport", "hour").toDF("srcip", "srcport", "hour")
    return joins.subtract(flows.select("srcip", "srcport", "hour"), found)


@query("combine_virus_data", "SELECT ip, 'live' AS origin, " + ", ".join(SEVEN) + " FROM totals UNION ALL SELECT dstip, 'labelled', "
       + ", ".join(f"CAST(sum({f}) AS BIGINT)" for f in SEVEN) + " FROM flows_wide GROUP BY dstip", ("totals", "flows_wide"))
def combine_virus_data(spark, d):
    """Sums of the live flows with those of a second, labelled feed."""
    wide = fx.flows_wide(spark, d)
    live = agg.ip_totals(agg.own_side(wide)).withColumn("origin", F.lit("live"))
    feed = agg.ip_totals(wide.withColumnRenamed("dstip", "ip")).withColumn("origin", F.lit("labelled"))
    return joins.union_all([live, feed])
