"""End-to-end jobs."""

from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.operators import aggregates as agg
from flowlens.operators import baselines, models
from flowlens.plans import jobs
from flowlens.queries.parts import SEVEN, open_lists, part
from flowlens.queries.registry import query
from flowlens.queries.relational import _KIND, AUDITED, NEW_ASSETS, day, largest, last_labels, split_flows
from flowlens.queries.rows import NORMALIZED_MONIFLOW, NORMALIZED_NETFLOW
from flowlens.queries.verdicts import JUDGED_FLOWS, RULES, _portrait_flows
from flowlens.session import scratch_path
from flowlens.sources import fixtures as fx
from flowlens.sources import readers, writers
from flowlens.streaming.new_assets import stream_new_assets

_COMMON = '"row", srcip, dstip, srcport, dstport, flowd'


@query("prepared_logs", f"""
SELECT 'netflow' AS kind, CAST("row" AS VARCHAR) AS "row", srcip, dstip, srcport, dstport, flowd FROM ({NORMALIZED_NETFLOW})
UNION ALL SELECT 'moniflow', CAST("row" AS VARCHAR), srcip, dstip, srcport, dstport, flowd FROM ({NORMALIZED_MONIFLOW})""", ("raw_netflow", "audited"))
def prepared_logs(spark, d):
    """Both logs prepared, stored as text and read back."""
    base = scratch_path(spark, "prepared")
    writers.write_if_any(jobs.prepare_netflow(fx.raw_netflow(spark, d), fx.INNER), lambda df: writers.write_tsv(df, base + "/netflow"))
    writers.write_if_any(jobs.prepare_moniflow(fx.moniflow(spark, d), fx.INNER), lambda df: writers.write_tsv(df, base + "/moniflow"))
    columns = ["row", "srcip", "dstip", "srcport", "dstport", "flowd"]

    def back(kind):
        out = readers.read_tsv(spark, f"{base}/{kind}").select(F.lit(kind).alias("kind"), *columns)
        return out.withColumns({c: F.col(c).cast("int") for c in ("srcport", "dstport")})

    return back("netflow").unionByName(back("moniflow"))


@query("asset_groups", f"""
SELECT g.ip, g.label, {', '.join('g.' + f for f in SEVEN)}, g.features, g.center, round(g.distance, 6) AS distance, p.label AS last_label,
       CAST(g.label IS DISTINCT FROM p.label AS INT) AS changed FROM grouped g LEFT JOIN last_labels p ON p.ip = g.ip""", ("grouped", "last_labels"))
def asset_groups(spark, d):
    out = jobs.asset_groups(fx.flows_wide(spark, d), last=last_labels(spark, d))
    return out.withColumns({"distance": F.round("distance", 6), "changed": F.col("changed").cast("int")})


@query("behaviour_recommendations")
def behaviour_recommendations(spark, d):
    return jobs.behaviour_recommendations(fx.moniflow(spark, d))


part("rated", 'SELECT ip, host, CAST(count(host) AS DOUBLE) AS "count" FROM visits GROUP BY ip, host', "visits")
part("rated_norms", 'SELECT ip, sqrt(sum("count" * "count")) AS n FROM rated GROUP BY ip', "rated")
part("rated_pairs", """
SELECT ip1, ip2, round(s, 3) AS sim, shared FROM (
  SELECT a.ip AS ip1, b.ip AS ip2, sum(a."count" * b."count" / (na.n * nb.n)) AS s, count(*) AS shared
  FROM rated a JOIN rated b ON a.host = b.host AND a.ip < b.ip JOIN rated_norms na ON na.ip = a.ip JOIN rated_norms nb ON nb.ip = b.ip
  GROUP BY a.ip, b.ip) WHERE s >= 0.7 - 1e-12""", "rated", "rated_norms")
part("rated_items", """
SELECT host1, host2, s FROM (
  SELECT a.host AS host1, b.host AS host2, sum(a."count" * b."count") / (sqrt(any_value(na.q)) * sqrt(any_value(nb.q))) AS s
  FROM rated a JOIN rated b ON a.ip = b.ip AND a.host < b.host
  JOIN (SELECT host, sum("count" * "count") AS q FROM rated GROUP BY host) na ON na.host = a.host
  JOIN (SELECT host, sum("count" * "count") AS q FROM rated GROUP BY host) nb ON nb.host = b.host
  GROUP BY a.host, b.host) WHERE s >= 0.7 - 1e-12""", "rated")
CLTIME = "2024-01-08 00:00:00"


@query("behaviour_similarities", "SELECT ip1, ip2, sim, shared FROM rated_pairs", "rated_pairs")
def behaviour_similarities(spark, d):
    """Similar addresses of the normalised hosts with the number of hosts they share."""
    _, rated = jobs.behaviour_ratings(fx.moniflow(spark, d))
    return jobs.similar_addresses(rated)[1].groupBy("ip1", "ip2", "sim").agg(F.count(F.lit(1)).alias("shared"))


@query("behaviour_similarity_tables", f"""
SELECT kind, object, other_object, data_type, cltime, sim FROM (
  SELECT 'users' AS kind, ip1 AS object, ip2 AS other_object, 'U' AS data_type, '{CLTIME}' AS cltime, round(sim, 3) AS sim FROM rated_pairs
  UNION ALL SELECT 'items', host1, host2, 'V', '{CLTIME}', round(s, 3) FROM rated_items
  UNION ALL SELECT 'reasons', p.ip1, p.ip2, a.host, '{CLTIME}', round(a."count" / b."count", 3) FROM rated_pairs p
  JOIN rated a ON a.ip = p.ip1 JOIN rated b ON b.ip = p.ip2 AND b.host = a.host)""", ("rated_pairs", "rated_items", "rated"))
def behaviour_similarity_tables(spark, d):
    """The three published similarity tables, one under the other; of the reasons, host and rate."""
    tables = jobs.behaviour_similarities(fx.moniflow(spark, d), CLTIME)
    three = lambda c: F.round(F.col(c).cast("double"), 3).alias("sim")
    same = [tables[k].select(F.lit(k).alias("kind"), "object", "other_object", "data_type", "cltime", three("sim")) for k in ("users", "items")]
    reasons = tables["reasons"].select(F.lit("reasons").alias("kind"), F.col("ip").alias("object"), F.col("other_ip").alias("other_object"),
                                       F.col("host").alias("data_type"), "cltime", three("rate"))
    return same[0].unionByName(same[1]).unionByName(reasons)


@query("host_clusters")
def host_clusters(spark, d):
    return jobs.host_clusters(fx.moniflow(spark, d))


@query("netflow_clusters")
def netflow_clusters(spark, d):
    return jobs.netflow_clusters(fx.flows_wide(spark, d)).withColumn("distance", F.round("distance", 6))


@query("netflow_cluster_points")
def netflow_cluster_points(spark, d):
    points = jobs.netflow_cluster_tables(jobs.netflow_clusters(fx.flows_wide(spark, d)))["points"]
    return points.withColumn("distance", F.round("distance", 6))


@query("netflow_cluster_centers")
def netflow_cluster_centers(spark, d):
    return jobs.netflow_cluster_tables(jobs.netflow_clusters(fx.flows_wide(spark, d)))["centers"]


@query("flow_outliers")
def flow_outliers(spark, d):
    out = jobs.flow_outliers(fx.flows(spark, d))
    return out.select(
        "recordtime", "srcip", "dstip", "proto", "num1", "num2", *[F.round(c, 6).alias(c) for c in ("unusual1", "unusual2", "unusuals")]
    )


@query("port_portrait", 'SELECT name, "row", port, abport, "index", packernum FROM portrait', "portrait")
def port_portrait(spark, d):
    flows = fx.port_flows(spark, d)
    span = lambda w: readers.in_time_range(flows, "recordtime", *w)
    out = jobs.port_portrait(span(fx.CURRENT), span(fx.HISTORY))
    return out.select("name", "row", "port", "abport", "index", "packernum")


open_lists("current_classified")
largest("current_classified")


def _portrait_tables(spark, d):
    flows = fx.port_flows(spark, d)
    span = lambda w: readers.in_time_range(flows, "recordtime", *w)
    return jobs.port_portrait_tables(span(fx.CURRENT), span(fx.HISTORY))


@query("port_portrait_today", "SELECT * FROM current_classified_max", "current_classified_max")
def port_portrait_today(spark, d):
    return _portrait_tables(spark, d)["today"]


@query("port_portrait_bounds", """
SELECT name, port, proto, CAST(0 AS DOUBLE) AS connectdown, connectup, CAST(0 AS DOUBLE) AS netflowdown, netflowup, baseline
FROM history_classified_mean""", "history_classified_mean")
def port_portrait_bounds(spark, d):
    return _portrait_tables(spark, d)["bounds"]


@query("port_portrait_simple", "SELECT * FROM merged_simple_sigma", "merged_simple_sigma")
def port_portrait_simple(spark, d):
    return jobs.port_portrait_simple(fx.port_flows(spark, d))


@query("flow_baseline", f"SELECT \"index\", proto, hour, count(*) AS n FROM ({JUDGED_FLOWS}) GROUP BY 1, 2, 3", ("current_flows", "history_week"))
def flow_baseline(spark, d):
    day, week = split_flows(spark, d)
    return jobs.flow_baseline(day, week).groupBy("index", "proto", "hour").agg(F.count(F.lit(1)).alias("n"))


day("current_day", "current_flows")


def _report(spark, d, which, *numbers):
    out = jobs.flow_baseline_tables(*split_flows(spark, d))[which]
    return out.withColumns({c: F.round(c, 6) for c in numbers})


@query("flow_baseline_day", """
SELECT name, 'daybaseline' AS "index", proto, hour AS date, CAST(-3 AS DOUBLE) AS connectdown, CAST(-3 AS DOUBLE) AS connectup,
       CAST(-3 AS DOUBLE) AS netflowdown, CAST(-3 AS DOUBLE) AS netflowup, connectavg, netflowavg, baseline FROM current_day""", "current_day")
def flow_baseline_day(spark, d):
    return _report(spark, d, "day", "netflowavg")


FLOW_BASELINE_WEEK = """
SELECT name, 'weekbaseline' AS "index", proto, hour AS date, CAST(-2 AS DOUBLE) AS connectdown, round(connectup, 6) AS connectup,
       CAST(-2 AS DOUBLE) AS netflowdown, round(netflowup, 6) AS netflowup, CAST(-2 AS DOUBLE) AS connectavg, CAST(-2 AS DOUBLE) AS netflowavg,
       baseline FROM history_week"""


@query("flow_baseline_week", FLOW_BASELINE_WEEK, "history_week")
def flow_baseline_week(spark, d):
    return _report(spark, d, "week", "connectup", "netflowup")


@query("flow_baseline_stored_week", FLOW_BASELINE_WEEK, "history_week")
def flow_baseline_stored_week(spark, d):
    """The same bounds from a store of daily partials, each day written by a run of its own."""
    path, history = scratch_path(spark, "days"), split_flows(spark, d)[1]
    baselines.store_days(history, path)
    last = history.agg(F.to_date(F.max("recordtime"))).scalar()
    baselines.store_days(history.where(F.to_date("recordtime") == last), path)  # the last day comes again and replaces itself
    week = baselines.week_from_store(spark.read.parquet(path))
    out = baselines.baseline_report(week, "weekbaseline")
    return out.withColumns({c: F.round(c, 6) for c in ("connectup", "netflowup")})


part("repeat_sized", 'SELECT *, count(*) OVER (PARTITION BY srcip, dstip, proto, recordtime) AS flownums FROM repeats WHERE prediction > 0', "repeats")


@query("flow_attacks", f"""
SELECT attacktype, srcip, dstip, proto, srcport, dstport, strftime(s.recordtime, '%Y-%m-%d %H:%M:%S') AS recordtime, flownums, count(*) AS flownuma
FROM (SELECT *, {_KIND} AS attacktype FROM repeat_sized) s WHERE attacktype <> '' AND flownums > 10
GROUP BY attacktype, srcip, dstip, proto, srcport, dstport, s.recordtime, flownums""", "repeat_sized")
def flow_attacks(spark, d):
    return jobs.flow_attacks(fx.flows(spark, d)).withColumn("recordtime", ff.time_text(F.col("recordtime")))


@query("flow_attacks_forest")
def flow_attacks_forest(spark, d):
    """The whole chain: order and repeats, classes from a stored forest, counts, names."""
    path = scratch_path(spark, "forest")
    writers.save_model(models.forest_fit(fx.labelled_flows(spark, d)), path)
    out = jobs.flow_attacks(fx.flows(spark, d), readers.load_model(path))
    return out.withColumn("recordtime", ff.time_text(F.col("recordtime")))


@query("sql_audit", f"SELECT * FROM ({AUDITED})", "genlog")
def sql_audit(spark, d):
    return jobs.sql_audit(fx.genlog(spark, d))


@query("new_assets", NEW_ASSETS, ("flows", "known"))
def new_assets(spark, d):
    out = jobs.new_asset_report(fx.flows(spark, d), fx.asset_register(spark, d), fx.assets_found(spark, d), fx.ASSET_RANGES)
    return out.withColumn("storagetime", ff.time_text(F.col("storagetime")))


@query("web_rules", RULES, ("closed", "masks", "set_hosts"))
def web_rules(spark, d):
    return jobs.web_rules(fx.moniflow(spark, d)).withColumn("confidence", F.round("confidence", 6))


@query("url_attacks")
def url_attacks(spark, d):
    """Attack verdicts of the inbound URLs; in the training texts, URLs with a page parameter stand for attacks."""
    from flowlens.functions.text import tokenize_uris

    audited = fx.audited(spark, d)
    texts = tokenize_uris(audited.select("id", "uri"))
    labelled = texts.select(F.when(F.col("uri").contains("page="), 0.0).otherwise(1.0).alias("label"), "urltext")
    path = scratch_path(spark, "url-model")
    models.url_fit(labelled, path=path)
    out = jobs.url_attacks(audited, readers.load_model(path))
    return out.withColumn("date", ff.time_text(F.col("date")))


@query("asset_portrait")
def asset_portrait(spark, d):
    return jobs.asset_portrait(_portrait_flows(spark, d), fx.moniflow(spark, d))


@query("asset_portrait_points")
def asset_portrait_points(spark, d):
    return jobs.asset_portrait_tables(_portrait_flows(spark, d), fx.moniflow(spark, d))["points"].withColumn("distance", F.round("distance", 6))


@query("stream_new_assets", "SELECT DISTINCT ip, side FROM (" + NEW_ASSETS + ")", ("flows", "known"))
def stream_new_assets_query(spark, d):
    """New assets found by a stream over the arriving flow files."""
    base = scratch_path(spark, "stream")
    fx.flows(spark, d).write.parquet(base + "/in")
    from flowlens.operators.assets import known_assets

    known = known_assets(fx.asset_register(spark, d), fx.assets_found(spark, d))
    arriving = spark.readStream.schema(spark.read.parquet(base + "/in").schema).parquet(base + "/in")
    stream_new_assets(arriving, known, fx.ASSET_RANGES, base + "/out", base + "/state").awaitTermination()
    return spark.read.parquet(base + "/out").select("ip", "side").distinct()
