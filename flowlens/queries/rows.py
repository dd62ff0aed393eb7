"""Sources and row-level operators."""

from datetime import datetime

from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.functions import text as tx
from flowlens.functions.ip import in_ranges, ip_to_long, semi_join_ranges, text_to_long
from flowlens.functions.windows import run_window
from flowlens.operators import aggregates as agg
from flowlens.operators import assets, joins, models
from flowlens.operators.scaling import Weights, min_max_scale, scale_zero_max, weighted_scores
from flowlens.plans import jobs
from flowlens.queries.parts import DAY_PART, INNER, SEVEN, direction
from flowlens.queries.registry import query
from flowlens.sources import fixtures as fx
from flowlens.sources import file_store, readers, writers
from flowlens.session import scratch_path

FLOW_COLUMNS = ["row", "srcip", "dstip", "srcport", "dstport", "proto", "packernum", "bytesize", "costtime", "flowd"]
_FLOW_SQL = ", ".join(f'"{c}"' for c in FLOW_COLUMNS)
_FLOW_TEXT = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in FLOW_COLUMNS)


# -- sources -----------------------------------------------------------------------------------------------------------


@query("scan_time_range", """
SELECT id, srcip, dstip, appproto, host, strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM moniflow
WHERE date BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-08 00:00:00'""", "moniflow")
def scan_time_range(spark, d):
    lo, hi = run_window(datetime(2024, 1, 10, 7, 30), "week")
    rows = readers.in_time_range(fx.moniflow(spark, d), "date", lo, hi)
    return rows.select("id", "srcip", "dstip", "appproto", "host", ff.time_text(F.col("date")).alias("date"))


@query("scan_catalog_table", """
SELECT "ROW", "SRCIP", strftime(TRY_CAST("STARTTIME" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS "STARTTIME",
       strftime(TRY_CAST("ENDTIME" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS "ENDTIME", TRY_CAST("SRCPORT" AS INT) AS "SRCPORT",
       TRY_CAST(TRY_CAST("DSTPORT" AS DOUBLE) AS INT) AS "DSTPORT", TRY_CAST(TRY_CAST("PACKERNUM" AS DOUBLE) AS INT) AS "PACKERNUM",
       TRY_CAST("BYTESIZE" AS INT) AS "BYTESIZE" FROM stored""", "stored")
def scan_catalog_table(spark, d):
    columns = ["ROW", "SRCIP", "STARTTIME", "ENDTIME", "SRCPORT", "DSTPORT", "PACKERNUM", "BYTESIZE"]
    out = readers.read_catalog_table(fx.stored_netflow(spark, d), "T_SIEM_NETFLOW", columns)
    return out.withColumns({c: ff.time_text(F.col(c)) for c in ("STARTTIME", "ENDTIME")})


_CELLS = "STARTTIME ENDTIME PROTO PACKERNUM BYTESIZE SRCIP DSTIP RECORDTIME ROW SRCPORT DSTPORT".split()


@query("scan_with_completeness_flag", "SELECT " + ", ".join(f"coalesce(\"{c}\", '-') AS \"{c}\"" for c in _CELLS)
       + ", CASE WHEN " + " OR ".join(f'"{c}" IS NULL' for c in _CELLS) + " THEN '0' ELSE '1' END AS \"FLAG\" FROM stored", "stored")
def scan_with_completeness_flag(spark, d):
    return readers.with_completeness_flag(fx.stored_netflow(spark, d), "netflow")


@query("scan_non_null_cells", 'SELECT "ROW", "SRCIP", "STARTTIME", "PROTO" FROM stored WHERE "STARTTIME" IS NOT NULL', "stored")
def scan_non_null_cells(spark, d):
    return readers.only_complete(fx.stored_netflow(spark, d).select("ROW", "SRCIP", "STARTTIME", "PROTO"), ["STARTTIME"])


@query("scan_tsv", f"SELECT {_FLOW_TEXT} FROM flows", "flows")
def scan_tsv(spark, d):
    path = scratch_path(spark, "tsv")
    writers.write_tsv(fx.flows(spark, d).select(FLOW_COLUMNS), path)
    return readers.read_tsv(spark, path)


@query("scan_daily_dirs", f"SELECT CAST(hour AS VARCHAR) AS hour, {_FLOW_TEXT} FROM flows", "flows")
def scan_daily_dirs(spark, d):
    """One directory per hour value (1-7), standing in for days; two days of the window have none and are skipped."""
    base, now = scratch_path(spark, "daily"), datetime(2024, 1, 8, 9)
    flows = fx.flows(spark, d)
    for hour in range(1, 8):
        folder = readers.day_folder(datetime(2024, 1, hour))
        writers.write_tsv(flows.where(F.col("hour") == hour).select("hour", *FLOW_COLUMNS), f"{base}/{folder}")
    return readers.read_daily_dirs(spark, base, now, -9, -1)


@query("scan_jdbc_subquery", "SELECT DISTINCT ip FROM known", "known")
def scan_jdbc_subquery(spark, d):
    """Register and earlier findings from two stores, which take the filters on status and flag."""
    path = scratch_path(spark, "register")
    writers.append_rows(fx.asset_register(spark, d), file_store.at(spark, path + "/devices"))
    writers.append_rows(fx.assets_found(spark, d), file_store.at(spark, path + "/found"))
    devices = file_store.at(spark, path + "/devices", ["ip", "status"]).read(spark)
    found = file_store.at(spark, path + "/found", ["ip", "flg"]).read(spark)
    return assets.known_assets(devices, found).distinct()


@query("scan_text_list", f"""
SELECT ip, {', '.join(SEVEN)} FROM totals WHERE ip IN (SELECT ip FROM register WHERE status <> 2)""", ("totals", "register"))
def scan_text_list(spark, d):
    path = scratch_path(spark, "list")
    fx.asset_register(spark, d).where("status <> 2").select("ip").write.text(path)
    totals = agg.ip_totals(agg.own_side(fx.flows_wide(spark, d)))
    return joins.keep_listed(totals, readers.read_text_list(spark, path, "listed"), "ip", "listed")


@query("scan_or_rebuild", 'SELECT ip, host, "count" FROM ratings', "ratings")
def scan_or_rebuild(spark, d):
    path = scratch_path(spark, "ratings")
    readers.read_or_rebuild(spark, path, lambda: fx.ratings(spark, d))
    return readers.read_or_rebuild(spark, path, lambda: fx.ratings(spark, d))


@query("load_model")
def load_model(spark, d):
    path = scratch_path(spark, "model")
    sample = fx.labelled_flows(spark, d)
    writers.save_model(models.forest_fit(sample), path)
    scored = models.forest_predict(readers.load_model(path), sample)
    return scored.groupBy("attacktype", "prediction").count()


@query("scan_labelled_sample", """
SELECT attacktype, "row" AS recordid FROM (SELECT "row", CAST(CASE WHEN packernum <= 2 THEN 4 WHEN proto = 'UDP' AND bytesize > 40000 THEN 2
  WHEN proto = 'TCP' AND bytesize > 60000 THEN 1 WHEN proto = 'TCP' THEN 0 ELSE 3 END AS VARCHAR) AS attacktype FROM flows WHERE hour = 3)
UNION ALL SELECT '0', "row" FROM (SELECT "row" FROM flows WHERE hour <> 3 ORDER BY "row" LIMIT (SELECT count(*) FROM flows WHERE hour = 3))""", "flows")
def scan_labelled_sample(spark, d):
    """All labelled flows (one hour was labelled), every class, and as many live ones."""
    labelled = fx.labelled_flows(spark, d, F.col("hour") == 3).select("attacktype", "recordid")
    live = fx.flows(spark, d).where("hour <> 3").select(F.lit("0").alias("attacktype"), F.col("row").alias("recordid"))
    return models.balanced_sample(labelled, live, "recordid")


@query("scan_labelled_urls", """
SELECT doc_id, CAST(label AS INT) AS label FROM (SELECT doc_id, CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id))
UNION ALL SELECT doc_id, 1 FROM (SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
  ORDER BY doc_id LIMIT (SELECT 10 * count(*) FROM documents JOIN labels USING (doc_id)))""")
def scan_labelled_urls(spark, d):
    """All labelled texts and up to ten times as many unlabelled ones as normal."""
    labelled = fx.labelled_urls(spark, d).select("doc_id", F.col("label").cast("int").alias("label"))
    live = fx.url_texts(spark, d).join(labelled.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(1).alias("label"))
    return models.balanced_sample(labelled, live, "doc_id", factor=10)


# -- projections -------------------------------------------------------------------------------------------------------

_HOT4 = ", ".join(f"CASE WHEN upper(proto) = '{p}' THEN 1 ELSE 0 END AS {p.lower()}" for p in ff.FLOW_PROTOCOLS)
_APP = ", ".join(f"CASE WHEN appproto = '{p}' THEN 1 ELSE 0 END AS {p.lower()}" for p in ff.APP_PROTOCOLS)
_METHOD = ", ".join(f"CASE WHEN method = '{p}' THEN 1 ELSE 0 END AS {p.lower()}" for p in ff.HTTP_METHODS)

NORMALIZED_NETFLOW = f"""
SELECT recordid AS "row", proto, strftime(make_timestamp(recordtime * 1000000), '%Y-%m-%d %H:%M:%S') AS recordtime,
       uppkts + downpkts AS packernum, ups + downs AS bytesize, srcip, dstip, srcport, dstport, {_HOT4},
       lasttime - starttime AS costtime, {direction('srcip', 'dstip', INNER)} AS flowd FROM raw_netflow"""


@query("normalize_netflow", NORMALIZED_NETFLOW, "raw_netflow")
def normalize_netflow(spark, d):
    return jobs.prepare_netflow(fx.raw_netflow(spark, d), fx.INNER)


NORMALIZED_MONIFLOW = f"""
SELECT id AS "row", strftime(date, '%Y-%m-%d %H:%M:%S') AS date, srcip, dstip, appproto, srcport, dstport, method, uri, host,
       {_APP}, {_METHOD}, flowd FROM audited WHERE flowd = '1'"""


@query("normalize_moniflow", NORMALIZED_MONIFLOW, "audited")
def normalize_moniflow(spark, d):
    out = jobs.prepare_moniflow(fx.moniflow(spark, d), fx.INNER)
    return out.withColumn("date", ff.time_text(F.col("date")))


@query("proto_one_hot", f'SELECT "row", proto, {_HOT4} FROM flows', "flows")
def proto_one_hot(spark, d):
    return fx.flows(spark, d).select("row", "proto").withColumns(ff.one_hot(F.col("proto"), ff.FLOW_PROTOCOLS))


@query("app_one_hot", f"SELECT id, {_APP}, {_METHOD} FROM moniflow", "moniflow")
def app_one_hot(spark, d):
    hot = {**ff.one_hot(F.col("appproto"), ff.APP_PROTOCOLS), **ff.one_hot(F.col("method"), ff.HTTP_METHODS)}
    return fx.moniflow(spark, d).select("id", *[c.alias(n) for n, c in hot.items()])


@query("flow_direction", 'SELECT "row", srcip, dstip, flowd FROM flows', "flows")
def flow_direction(spark, d):
    return fx.flows(spark, d).select("row", "srcip", "dstip", "flowd")


@query("flow_duration", """
SELECT "ROW", coalesce(epoch_ms(TRY_CAST("ENDTIME" AS TIMESTAMP)) - epoch_ms(TRY_CAST("STARTTIME" AS TIMESTAMP)), -1) AS costtime
FROM stored""", "stored")
def flow_duration(spark, d):
    out = jobs.prepare_stored_netflow(fx.stored_netflow(spark, d), fx.INNER)
    return out.select(F.col("row").alias("ROW"), "costtime")


@query("epoch_to_time", """
SELECT "row", strftime(make_timestamp(firstrecvtime * 1000000), '%Y-%m-%d %H:%M:%S') AS from_seconds,
       strftime(make_timestamp(firstrecvtime * 1000000), '%Y-%m-%d %H:%M:%S') AS from_millis FROM genlog""", "genlog")
def epoch_to_time(spark, d):
    t = F.col("firstrecvtime")
    return fx.genlog(spark, d).select(
        "row", ff.epoch_text(t, "s").alias("from_seconds"), ff.epoch_text(t * 1000, "ms").alias("from_millis")
    )


@query("hour_of_day", "SELECT id, CAST(hour(date) AS VARCHAR) AS hour FROM moniflow", "moniflow")
def hour_of_day(spark, d):
    return fx.moniflow(spark, d).select("id", ff.hour_label(F.col("date")).alias("hour"))


@query("time_of_day_bucket", f"SELECT id, {DAY_PART} AS time FROM moniflow", "moniflow")
def time_of_day_bucket(spark, d):
    return fx.moniflow(spark, d).select("id", ff.time_of_day(F.col("date")).alias("time"))


@query("shift_time", """
SELECT "row", strftime(recordtime + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS later,
       strftime(recordtime - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS earlier FROM flows""", "flows")
def shift_time(spark, d):
    t = F.col("recordtime")
    return fx.flows(spark, d).select(
        "row", ff.time_text(ff.shift_hours(t, 8)).alias("later"), ff.time_text(ff.shift_hours(t, -8)).alias("earlier")
    )


@query("normalize_host", f"""
SELECT id, host, regexp_extract(host, '{tx.HOST_PATTERN}', 1) AS name,
       regexp_extract(host, '{tx.HOST_PATTERN_STRICT}', 1) AS strict_name FROM moniflow""", "moniflow")
def normalize_host(spark, d):
    h = F.col("host")
    return fx.moniflow(spark, d).select(
        "id", "host", tx.normalize_host(h).alias("name"), tx.normalize_host(h, strict=True).alias("strict_name")
    )


@query("tokenize_uri", r"""
SELECT id, uri, regexp_replace(regexp_replace(uri, '([/=?%.\-_&:''(),|*+;])', ' \1 ', 'g'), '^ ', '') AS urltext
FROM (SELECT id, CASE WHEN contains(uri, '%') THEN url_decode(replace(uri, '+', ' ')) ELSE uri END AS uri FROM moniflow)
WHERE contains(uri, '?') AND contains(uri, '=')""", "moniflow")
def tokenize_uri(spark, d):
    return tx.tokenize_uris(fx.moniflow(spark, d).select("id", "uri"))


_LONG = " + ".join(f"TRY_CAST(split_part({{0}}, '.', {i}) AS BIGINT) * {256 ** (4 - i)}" for i in range(1, 5))


@query("ip_to_long", f'SELECT "row", {_LONG.format("srcip")} AS src, {_LONG.format("dstip")} AS dst FROM flows', "flows")
def ip_to_long_query(spark, d):
    return fx.flows(spark, d).select("row", ip_to_long(F.col("srcip")).alias("src"), ip_to_long(F.col("dstip")).alias("dst"))


@query("ip_in_ranges", f"""
SELECT "row", srcip, CAST({_LONG.format("dstip")} BETWEEN 167772160 AND 167837951 AS INT) AS dst_in FROM flows
WHERE {_LONG.format("srcip")} BETWEEN 167772160 AND 167837951""", "flows")
def ip_in_ranges(spark, d):
    """Source by a range table (semi join), destination by the configured list (expression)."""
    bounds = [(text_to_long(lo), text_to_long(hi)) for lo, hi in fx.ASSET_RANGES]
    ranges = spark.createDataFrame(bounds, "lo bigint, hi bigint")
    kept = semi_join_ranges(fx.flows(spark, d).select("row", "srcip", "dstip"), "srcip", ranges, "row")
    return kept.select("row", "srcip", in_ranges(F.col("dstip"), fx.ASSET_RANGES).cast("int").alias("dst_in"))


@query("record_id", """
SELECT "row", sha256(concat_ws('|', "row", srcip, srcport)) AS recordid FROM flows""", "flows")
def record_id(spark, d):
    return fx.flows(spark, d).select("row", ff.record_id(F.col("row"), F.col("srcip"), F.col("srcport")).alias("recordid"))


@query("batch_metadata", """
SELECT ip, host, "count", '0a1b' AS clno, '2024-01-08 00:00:00' AS cltime, 'STATS' AS data_type, 'ip#host' AS demo FROM ratings""", "ratings")
def batch_metadata(spark, d):
    return ff.add_batch(fx.ratings(spark, d), "0a-1b", "2024-01-08 00:00:00", data_type="STATS", demo="ip#host")


_LOWER = [p.lower() for p in ff.FLOW_PROTOCOLS]


@query("dominant_feature", """
SELECT ip, CASE WHEN greatest(tcp, udp, icmp, gre) <= 0 THEN '' WHEN tcp >= greatest(udp, icmp, gre) THEN 'TCP'
       WHEN udp >= greatest(icmp, gre) THEN 'UDP' WHEN icmp >= gre THEN 'ICMP' ELSE 'GRE' END AS proto,
       CAST(floor(round(packernum, 6)) AS BIGINT) AS packernum
FROM (SELECT ip, avg(tcp) AS tcp, avg(udp) AS udp, avg(icmp) AS icmp, avg(gre) AS gre, avg(packernum) AS packernum FROM own GROUP BY ip)""", "own")
def dominant_feature(spark, d):
    own = agg.own_side(fx.flows_wide(spark, d))
    means = own.groupBy("ip").agg(*[F.avg(c).alias(c) for c in (*_LOWER, "packernum")])
    name = ff.dominant_feature([F.col(p) for p in _LOWER], list(ff.FLOW_PROTOCOLS))
    return means.select("ip", name.alias("proto"), ff.truncated(F.round("packernum", 6)).alias("packernum"))


@query("pack_features", f"""
SELECT ip, concat_ws('#', {', '.join(SEVEN)}) AS packed, {', '.join(f'CAST({f} AS VARCHAR) AS {f}' for f in SEVEN)} FROM totals""", "totals")
def pack_features(spark, d):
    totals = agg.ip_totals(agg.own_side(fx.flows_wide(spark, d)))
    packed = totals.select("ip", ff.pack_features([F.col(f) for f in SEVEN]).alias("packed"))
    return packed.withColumns(ff.unpack_features(F.col("packed"), list(SEVEN)))


@query("null_defaults", """
SELECT "ROW", coalesce("STARTTIME", '-') AS starttime, coalesce(TRY_CAST("DSTPORT" AS INT), 0) AS dstport FROM stored""", "stored")
def null_defaults(spark, d):
    return fx.stored_netflow(spark, d).select(
        "ROW", ff.null_default(F.col("STARTTIME"), "-").alias("starttime"),
        F.coalesce(F.col("DSTPORT").try_cast("int"), F.lit(0)).alias("dstport"),
    )


@query("typed_cast", """
SELECT "ROW", TRY_CAST("PACKERNUM" AS DOUBLE) AS packernum, TRY_CAST("DSTPORT" AS INT) AS dstport,
       TRY_CAST("BYTESIZE" AS BIGINT) AS bytesize FROM stored""", "stored")
def typed_cast(spark, d):
    return fx.stored_netflow(spark, d).select(
        "ROW", F.col("PACKERNUM").try_cast("double").alias("packernum"), F.col("DSTPORT").try_cast("int").alias("dstport"),
        F.col("BYTESIZE").try_cast("bigint").alias("bytesize"),
    )


@query("weighted_score", "SELECT ip, round(proto, 6) AS proto, round(flow, 6) AS flow FROM scored", "scored")
def weighted_score(spark, d):
    scored = jobs.scored_assets(fx.flows_wide(spark, d))
    return scored.select("ip", F.round("proto", 6).alias("proto"), F.round("flow", 6).alias("flow"))


@query("scale_zero_max", """
SELECT ip, host, round(CASE WHEN max("count") OVER () = 0 THEN 0 ELSE "count" / max("count") OVER () END, 6) AS scaled FROM ratings""", "ratings")
def scale_zero_max_query(spark, d):
    return scale_zero_max(fx.ratings(spark, d), "count", "scaled").select("ip", "host", F.round("scaled", 6).alias("scaled"))


@query("min_max_scale", f"SELECT ip, {', '.join(f'round({f}_scl, 6) AS {f}' for f in SEVEN)} FROM scaled", "scaled")
def min_max_scale_query(spark, d):
    scaled = min_max_scale(agg.ip_totals(agg.own_side(fx.flows_wide(spark, d))), SEVEN)
    return scaled.select("ip", *[F.round(f + "_scl", 6).alias(f) for f in SEVEN])


@query("attack_type_map", """
SELECT "row", CASE WHEN prediction = 1 AND proto = 'TCP' THEN 'CC' WHEN prediction IN (2, 3) AND proto = 'UDP' THEN 'UDPFlood'
       WHEN prediction IN (2, 3) AND proto = 'TCP' THEN 'SYNFlood' WHEN prediction = 4 AND packernum = 1 THEN 'PORTSCAN'
       ELSE '' END AS attacktype FROM flows""", "flows")
def attack_type_map(spark, d):
    kind = ff.attack_type(F.col("prediction"), F.col("proto"), F.col("packernum"))
    return fx.flows(spark, d).select("row", kind.alias("attacktype"))


@query("sql_injection_filter", """
SELECT "row", eventname FROM genlog WHERE eventname = 'HTTP_SQL注入攻击' OR eventname LIKE 'SQL Injection%'""", "genlog")
def sql_injection_filter(spark, d):
    return fx.genlog(spark, d).where(ff.is_sql_injection(F.col("eventname"))).select("row", "eventname")


@query("http_behaviour_filter", """
SELECT id, CAST(appproto = 'HTTP' AND host IS NOT NULL AND host <> '' AS INT) AS current_form,
       CAST(appproto = 'HTTP' AND flowd = '0' OR flowd = '2' AS INT) AS old_form FROM audited
WHERE (appproto = 'HTTP' AND host IS NOT NULL AND host <> '') OR (appproto = 'HTTP' AND flowd = '0' OR flowd = '2')""", "audited")
def http_behaviour_filter(spark, d):
    now = ff.has_http_host(F.col("appproto"), F.col("host"))
    old = ff.old_http_filter(F.col("appproto"), F.col("flowd"))
    rows = fx.audited(spark, d).where(now | old)
    return rows.select("id", now.cast("int").alias("current_form"), old.cast("int").alias("old_form"))


@query("format_decimals", """
SELECT ip, host, printf('%.6f', "count" / 7) AS six, printf('%.3f', "count" / 7) AS three, printf('%.2f', "count" / 7) AS two FROM ratings""", "ratings")
def format_decimals(spark, d):
    x = F.col("count") / 7
    return fx.ratings(spark, d).select(
        "ip", "host", ff.decimals(x, 6).alias("six"), ff.decimals(x, 3).alias("three"), ff.decimals(x, 2).alias("two")
    )


_IN = f"{_LONG} BETWEEN 167772160 AND 167837951"


@query("asset_candidate_filter", f"""
SELECT "row", 'src' AS side, srcip AS ip FROM flows WHERE {_IN.format('srcip')} AND proto <> 'ICMP' AND srcip NOT IN (SELECT ip FROM known)
UNION ALL
SELECT "row", 'dst', dstip FROM flows WHERE {_IN.format('dstip')} AND proto = 'TCP' AND packernum > 2 AND dstip NOT IN (SELECT ip FROM known)""", ("flows", "known"))
def asset_candidate_filter(spark, d):
    flows = fx.flows(spark, d)
    known = assets.known_assets(fx.asset_register(spark, d), fx.assets_found(spark, d))
    src = assets.source_candidates(flows, known, fx.ASSET_RANGES).select("row", F.lit("src").alias("side"), F.col("srcip").alias("ip"))
    dst = assets.destination_candidates(flows, known, fx.ASSET_RANGES).select("row", F.lit("dst").alias("side"), F.col("dstip").alias("ip"))
    return src.unionByName(dst)


@query("own_side_projection", "SELECT ip, flowd, packernum, bytesize FROM own", "own")
def own_side_projection(spark, d):
    return agg.own_side(fx.flows_wide(spark, d)).select("ip", "flowd", "packernum", "bytesize")


@query("run_window", """
SELECT 'day' AS job, count(*) FILTER (date BETWEEN TIMESTAMP '2024-01-09' AND TIMESTAMP '2024-01-10') AS n,
       '2024-01-09 00:00:00' AS lo, '2024-01-10 00:00:00' AS hi FROM moniflow
UNION ALL SELECT 'hour', count(*) FILTER (date BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-10 07:00:00'),
       '2024-01-10 06:00:00', '2024-01-10 07:00:00' FROM moniflow
UNION ALL SELECT 'month', count(*) FILTER (date BETWEEN TIMESTAMP '2023-12-10' AND TIMESTAMP '2024-01-10'),
       '2023-12-10 00:00:00', '2024-01-10 00:00:00' FROM moniflow
UNION ALL SELECT 'week', count(*) FILTER (date BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-08'),
       '2024-01-02 00:00:00', '2024-01-08 00:00:00' FROM moniflow""", "moniflow")
def run_window_query(spark, d):
    """Audit rows inside each default window, counted in one pass."""
    now = datetime(2024, 1, 10, 7, 30)
    spans = {j: run_window(now, j) for j in ("day", "hour", "month", "week")}
    cells = [
        F.struct(F.lit(j).alias("job"), F.count_if(F.col("date").between(lo, hi)).alias("n"), F.lit(str(lo)).alias("lo"), F.lit(str(hi)).alias("hi"))
        for j, (lo, hi) in spans.items()
    ]
    return fx.moniflow(spark, d).agg(F.array(*cells).alias("w")).select(F.inline("w"))


@query("inbound_filter", "SELECT id, srcip, dstip, uri FROM audited WHERE flowd = '1'", "audited")
def inbound_filter(spark, d):
    return fx.audited(spark, d).where(F.col("flowd") == ff.OUT_TO_IN).select("id", "srcip", "dstip", "uri")
