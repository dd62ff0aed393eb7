"""Sinks, checked by reading back what they wrote."""

from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.operators import aggregates as agg
from flowlens.operators import groups, models
from flowlens.plans import jobs
from flowlens.queries.parts import SEVEN
from flowlens.queries.registry import query
from flowlens.queries.relational import _KIND, NEW_ASSETS
from flowlens.session import scratch_path
from flowlens.sources import fixtures as fx
from flowlens.sources import file_store, readers, writers

_TOTALS_TEXT = "SELECT ip, " + ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in SEVEN) + " FROM totals"


def _totals(spark, d):
    return agg.ip_totals(agg.own_side(fx.flows_wide(spark, d)))


@query("sink_tsv", _TOTALS_TEXT, "totals")
def sink_tsv(spark, d):
    path = scratch_path(spark, "totals")
    writers.write_tsv(_totals(spark, d), path)
    return readers.read_tsv(spark, path)


@query("sink_single_file", _TOTALS_TEXT, "totals")
def sink_single_file(spark, d):
    path = scratch_path(spark, "single")
    writers.write_single_file(_totals(spark, d), path)
    return readers.read_tsv(spark, path)


@query("sink_json", "SELECT ip, " + ", ".join(SEVEN) + " FROM totals", "totals")
def sink_json(spark, d):
    path, totals = scratch_path(spark, "json"), _totals(spark, d)
    writers.write_json(totals, path)
    return spark.read.schema(totals.schema).json(path)


@query("sink_index", "SELECT ip, " + ", ".join(SEVEN) + " FROM totals", "totals")
def sink_index(spark, d):
    """Append to a store whose writes appear whole or not at all; any other format with a connector goes the same way."""
    target = file_store.at(spark, scratch_path(spark, "index"))
    writers.append_rows(_totals(spark, d), target)
    return target.read(spark)


@query("sink_catalog_table", """
SELECT "ROW", "SRCIP", strftime(TRY_CAST("STARTTIME" AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS "STARTTIME",
       TRY_CAST(nullif("SRCPORT", '-1') AS INT) AS "SRCPORT", TRY_CAST(nullif("DSTPORT", '') AS INT) AS "DSTPORT", TRY_CAST("BYTESIZE" AS INT) AS "BYTESIZE" FROM stored""", "stored")
def sink_catalog_table(spark, d):
    rows = fx.stored_netflow(spark, d).select("ROW", "SRCIP", "STARTTIME", "SRCPORT", "DSTPORT", "BYTESIZE")
    target = writers.Source("parquet", {}, scratch_path(spark, "catalog"))
    writers.write_catalog_table(rows, "T_SIEM_NETFLOW", target)
    return target.read(spark).withColumn("STARTTIME", ff.time_text(F.col("STARTTIME")))


_PORTS = """
SELECT "ROW", "SRCIP", TRY_CAST(nullif("SRCPORT", '-1') AS INT) AS "SRCPORT", TRY_CAST("BYTESIZE" AS INT) AS "BYTESIZE" FROM stored"""


@query("sink_keyed_table", f"""
SELECT "ROW", "SRCIP", "SRCPORT", "BYTESIZE" FROM (
  SELECT 1 AS write, * FROM ({_PORTS}) UNION ALL SELECT 2, "ROW", "SRCIP", 0, "BYTESIZE" FROM ({_PORTS}) WHERE "BYTESIZE" % 2 = 0)
QUALIFY row_number() OVER (
  PARTITION BY "ROW" ORDER BY write DESC, "SRCIP" DESC NULLS LAST, "SRCPORT" DESC NULLS LAST, "BYTESIZE" DESC NULLS LAST) = 1""", "stored")
def sink_keyed_table(spark, d):
    """A catalog table written twice: the second write holds the rows of even size again, with another port, and replaces them."""
    rows = fx.stored_netflow(spark, d).select("ROW", "SRCIP", "SRCPORT", "BYTESIZE")
    path = scratch_path(spark, "keyed")
    target = file_store.at(spark, path)
    writers.write_catalog_table(rows, "T_SIEM_NETFLOW", target)
    again = rows.where(F.col("BYTESIZE").try_cast("int") % 2 == 0).withColumn("SRCPORT", F.lit("0"))
    writers.write_catalog_table(again, "T_SIEM_NETFLOW", target)
    return file_store.latest(spark, path, "ROW")


@query("sink_jdbc", f"SELECT ip, side, 36 AS id_length FROM ({NEW_ASSETS})", ("flows", "known"))
def sink_jdbc(spark, d):
    """New assets with generated ids, appended to a store in one commit."""
    target = file_store.at(spark, scratch_path(spark, "found"))
    report = jobs.new_asset_report(fx.flows(spark, d), fx.asset_register(spark, d), fx.assets_found(spark, d), fx.ASSET_RANGES)
    writers.append_with_ids(report, target)
    return target.read(spark).select("ip", "side", F.length("recordid").alias("id_length"))


def _attacks(spark, d):
    out = agg.attack_summary(jobs.attacks_of(fx.flows(spark, d)))
    return out.withColumn("recordtime", ff.time_text(F.col("recordtime")))


@query("sink_dedup_results", f"""
SELECT DISTINCT attacktype, srcip, dstip, proto, srcport, dstport, strftime(s.recordtime, '%Y-%m-%d %H:%M:%S') AS recordtime, flownums
FROM (SELECT *, {_KIND} AS attacktype FROM sized) s WHERE attacktype <> '' AND flownums > 10""", "sized")
def sink_dedup_results(spark, d):
    target = writers.Source("parquet", {}, scratch_path(spark, "results"))
    rows = _attacks(spark, d)
    writers.save_results(rows.unionByName(rows), writers.FLOW_RESULT, [target], list(writers.FLOW_RESULT))
    out = target.read(spark).withColumn("recordtime", ff.time_text(F.col("recordtime")))
    return out.select("attacktype", "srcip", "dstip", "proto", "srcport", "dstport", "recordtime", "flownums")


@query("route_results", f"""
SELECT 'flow' AS target, count(*) AS n FROM (SELECT DISTINCT attacktype, srcip, dstip, proto, srcport, dstport, s.recordtime, flownums
  FROM (SELECT *, {_KIND} AS attacktype FROM sized) s WHERE attacktype <> '' AND flownums > 10)
UNION ALL SELECT 'catalog', count(*) FROM grouped""", ("sized", "grouped"))
def route_results(spark, d):
    """Two result files sent where their names say; the rows each target received."""
    base = scratch_path(spark, "routed")
    at = lambda name: writers.Source("parquet", {}, f"{base}/{name}")
    writers.write_routed(_attacks(spark, d), "RESULT@2024-01-08@NET.csv", [at("flow")], [at("url")], at("catalog"))
    points = _point_rows(spark, d)
    writers.write_routed(points, "T_SIEM_KMEANS_CLUSTER@2024-01-08@G.csv", [at("flow")], [at("url")], at("catalog"))
    counts = [at(n).read(spark).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("target"), "n") for n in ("flow", "catalog")]
    return counts[0].unionByName(counts[1])


def _point_rows(spark, d):
    """Cluster points in the stored layout."""
    report = groups.point_report(jobs.asset_groups(fx.flows_wide(spark, d)), tuple(f"{f}_text" for f in SEVEN))
    named = {"TCP": "tcp", "UDP": "udp", "ICMP": "icmp", "GRE": "gre", "TFTIME": "costtime", "PACKERNUM": "packernum", "BYTESIZE": "bytesize"}
    rows = report.select(
        F.col("ip").alias("NAME"), F.col("label").alias("CENTER_INDEX"), F.col("distance").cast("string").alias("DISTANCE"),
        F.col("features").alias("CLUSTER_INFO"), *[F.col(f"{f}_text").alias(n) for n, f in named.items()],
    )
    # Feature names and origin of the stored report.
    return rows.withColumns({
        "CLNO": F.lit("batch0"), "CLTIME": F.lit("2024-01-08 00:00:00"), "DATA_ORIGIN": F.lit("g"),
        "DEMO": F.lit("TCP#UDP#ICMP#GRE#tftime#packernum#bytesize"),
    })


_CELLS = 'tcp AS "TCP", udp AS "UDP", icmp AS "ICMP", gre AS "GRE", costtime AS "TFTIME", packernum AS "PACKERNUM", bytesize AS "BYTESIZE"'


@query("sink_cluster_points", f"""
SELECT ip AS "NAME", label AS "CENTER_INDEX", round(distance, 6) AS "DISTANCE", features AS "CLUSTER_INFO", {_CELLS},
       'batch0' AS "CLNO", '2024-01-08 00:00:00' AS "CLTIME", 'g' AS "DATA_ORIGIN", 'TCP#UDP#ICMP#GRE#tftime#packernum#bytesize' AS "DEMO" FROM grouped""", "grouped")
def sink_cluster_points(spark, d):
    """Stored twice: as the result and as the last result of the next run."""
    base, rows = scratch_path(spark, "points"), _point_rows(spark, d)
    writers.write_tsv(rows, base + "/result")
    writers.write_tsv(readers.read_tsv(spark, base + "/result"), base + "/last")
    back = readers.read_catalog_table(readers.read_tsv(spark, base + "/last"), "T_SIEM_KMEANS_CLUSTER", rows.columns)
    return back.withColumns({"DISTANCE": F.round("DISTANCE", 6), "CLTIME": ff.time_text(F.col("CLTIME"))})


@query("sink_cluster_centers", """
SELECT DISTINCT label, center, """ + ", ".join(
    f"CASE WHEN center = '0' THEN '0' ELSE split_part(center, '#', {i + 1}) END AS {f}" for i, f in enumerate(SEVEN)
) + " FROM grouped", "grouped")
def sink_cluster_centers(spark, d):
    path = scratch_path(spark, "centers")
    members = jobs.asset_groups(fx.flows_wide(spark, d)).select("label", "center")
    writers.write_tsv(groups.center_report(members, SEVEN), path)
    return readers.read_tsv(spark, path)


@query("save_model")
def save_model(spark, d):
    """The stored model predicts what the fitted one predicts."""
    path, rows = scratch_path(spark, "forest"), fx.labelled_flows(spark, d)
    model = models.forest_fit(rows)
    writers.save_model(model, path)
    writers.save_model(model, path)
    again = readers.load_model(path)
    fitted = models.forest_predict(model, rows).select("recordid", "prediction")
    loaded = models.forest_predict(again, rows).select("recordid", F.col("prediction").alias("stored"))
    return fitted.join(loaded, "recordid").groupBy((F.col("prediction") == F.col("stored")).alias("equal")).count()


@query("write_if_not_empty", "SELECT count(*) AS n, 'some' AS wrote FROM flows", "flows")
def write_if_not_empty(spark, d):
    """Written paths: an empty result writes nothing."""
    base, flows = scratch_path(spark, "maybe"), fx.flows(spark, d)
    writers.write_if_any(flows, lambda df: writers.write_json(df, base + "/some"))
    writers.write_if_any(flows.where("packernum < 0"), lambda df: writers.write_json(df, base + "/none"))
    wrote = [n for n in ("some", "none") if readers.path_exists(spark, f"{base}/{n}")]
    rows = spark.read.json(base + "/some").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("wrote", F.lit(",".join(wrote)))
