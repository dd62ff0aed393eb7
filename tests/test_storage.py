"""Sources and sinks."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens import schemas
from flowlens.operators import baselines
from flowlens.operators.assets import known_assets
from flowlens.plans import jobs
from flowlens.sources import fixtures as fx
from flowlens.sources import readers, writers
from flowlens.sources.readers import Source
from flowlens.streaming.new_assets import stream_new_assets


def test_catalog_schemas():
    net = schemas.table_schema("T_SIEM_NETFLOW")
    assert len(net) == 33 and net["SRCPORT"].dataType == T.IntegerType() and net["STARTTIME"].dataType == T.TimestampType()
    assert {f.dataType for f in schemas.table_schema("T_MONI_FLOW", typed=False)} == {T.StringType()}
    sizes = {t: len(schemas.table_schema(t)) for t in schemas.CATALOG}
    assert sizes == {"T_SIEM_NETFLOW": 33, "T_MONI_FLOW": 37, "T_SIEM_KMEANS_CENTER": 19, "T_SIEM_KMEANS_CLUSTER": 19, "T_SIEM_GENERAL_LOG": 48}


def test_typed_reads(spark):
    df = spark.createDataFrame([("r", "12.9", "x", "2024-01-01 00:00:00"), ("s", None, "7", "soon")], "ROW string, SRCPORT string, DSTPORT string, STARTTIME string")
    out = readers.read_catalog_table(df, "T_SIEM_NETFLOW", df.columns).collect()
    assert (out[0].SRCPORT, out[0].DSTPORT, out[0].STARTTIME) == (12, None, datetime(2024, 1, 1))
    assert (out[1].SRCPORT, out[1].DSTPORT, out[1].STARTTIME) == (None, 7, None)
    strings = readers.read_catalog_table(df, "T_SIEM_NETFLOW", df.columns, typed=False).collect()
    assert strings[0].SRCPORT == "12.9"


def test_typed_writes(spark):
    df = spark.createDataFrame([(" ", "-1", "80", "x")], "SRCIP string, SRCPORT string, DSTPORT string, BYTESIZE string")
    out = writers.to_catalog_types(df, "T_SIEM_NETFLOW")
    row = out.first()
    assert (row.SRCIP, row.SRCPORT, row.DSTPORT, row.BYTESIZE) == (None, None, 80, None)
    assert row.ROW == writers.to_catalog_types(df, "T_SIEM_NETFLOW").first().ROW


def test_completeness(spark):
    df = spark.createDataFrame([("1", "n"), ("2", None), ("-", "n")], "EVENT_RULE_ID string, EVENT_SUB_TYPE string")
    out = readers.with_completeness_flag(df, "event_rule").collect()
    assert [(r.EVENT_SUB_TYPE, r.FLAG) for r in out] == [("n", "1"), ("-", "0"), ("n", "0")]


def test_daily_dirs(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for folder in ("2024-01-05--2024-01-06", "2024-01-07--2024-01-08"):
        writers.write_tsv(df, str(tmp_path / folder))
    out = readers.read_daily_dirs(spark, str(tmp_path), datetime(2024, 1, 8))
    assert out.count() == 2 and dict(out.dtypes) == {"k": "string", "v": "string"}
    with pytest.raises(FileNotFoundError):
        readers.read_daily_dirs(spark, str(tmp_path), datetime(2023, 1, 8))


def test_time_range_is_inclusive_and_pushed(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    first = ev.agg(F.min("ts")).first()[0]
    assert readers.in_time_range(ev, "ts", first, first).count() == 1
    plan = readers.in_time_range(ev, "ts", "2024-01-02", "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_rebuild_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert readers.read_or_rebuild(spark, str(tmp_path / "x"), build).count() == 3
    assert len(calls) == 1


def test_text_list(spark, tmp_path):
    (tmp_path / "l.txt").write_text("10.0.0.1\n\n 10.0.0.2 \n")
    assert sorted(r.ip for r in readers.read_text_list(spark, str(tmp_path / "l.txt")).collect()) == ["10.0.0.1", "10.0.0.2"]


def test_subquery_source():
    src = Source("jdbc", {"url": "jdbc:any", "driver": "d"}).subquery("SELECT ip FROM t WHERE status <> 2", "devices")
    assert src.options["dbtable"] == "(SELECT ip FROM t WHERE status <> 2) devices" and src.options["url"] == "jdbc:any"


def test_routes():
    assert writers.route("T@2024-01-01@NET.csv") == ("flow", "T")
    assert writers.route("T @ d @ MONI.csv") == ("url", "T")
    assert writers.route("T_SIEM_KMEANS_CENTER@d@G.csv") == ("catalog", "T_SIEM_KMEANS_CENTER")


def test_single_file(spark, tmp_path):
    writers.write_single_file(spark.range(100).repartition(5), str(tmp_path / "one"))
    names = [p.name for p in (tmp_path / "one").iterdir()]
    assert len([n for n in names if n.startswith("part-")]) == 1 and "_SUCCESS" in names


def test_empty_results_are_not_written(spark, tmp_path):
    assert not writers.write_if_any(spark.range(0), lambda df: writers.write_json(df, str(tmp_path / "j")))
    assert writers.write_if_any(spark.range(1), lambda df: writers.write_json(df, str(tmp_path / "j")))


def test_shared_folder_is_the_sessions(spark):
    from flowlens.session import scratch_path, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_stream_of_new_assets_keeps_state_over_restarts(spark, sf_dir, tmp_path):
    """Files arrive in four runs, each a query that starts from the checkpoint: every address and side comes out once."""
    flows = fx.flows(spark, sf_dir)
    known = known_assets(fx.asset_register(spark, sf_dir), fx.assets_found(spark, sf_dir))
    schema = flows.schema
    counts = []
    for part in range(4):
        rows = flows.where(F.pmod(F.xxhash64("row"), F.lit(4)) <= part) if part % 2 else flows.where(F.pmod(F.xxhash64("row"), F.lit(4)) == part)
        rows.coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = stream_new_assets(arriving, known, fx.ASSET_RANGES, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        counts.append(spark.read.parquet(str(tmp_path / "out")).count())
        # the state holds the reported addresses, nothing of the flows
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == counts[-1]
    out = spark.read.parquet(str(tmp_path / "out")).select("ip", "side").collect()
    want = jobs.new_asset_report(flows, fx.asset_register(spark, sf_dir), fx.assets_found(spark, sf_dir), fx.ASSET_RANGES).select("ip", "side").distinct().collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, want)) and out and counts == sorted(counts)


def test_daily_store_replaces_only_the_days_it_gets(spark, sf_dir, tmp_path):
    flows, path = fx.flows(spark, sf_dir).where("srcip IS NOT NULL"), str(tmp_path / "days")
    baselines.store_days(flows, path)
    days = [r.date for r in spark.read.parquet(path).select("date").distinct().orderBy("date").collect()]
    files = lambda: {f"{p.parent.name}/{p.name}" for p in (tmp_path / "days").rglob("*.parquet")}
    before = files()
    baselines.store_days(flows.where(F.to_date("recordtime") == days[-1]), path)
    assert {f.split("/")[0] for f in before ^ files()} == {f"date={days[-1]}"}
    some = spark.read.parquet(path).where(F.col("date").isin(days[:3]))
    assert re.search(r"PartitionFilters: \[[^\]]*date", some._jdf.queryExecution().executedPlan().toString())
    raw = flows.where(F.to_date("recordtime").isin(days[:3]))
    keys = ["name", "proto", "hour", "baseline"]
    for stored_, plain, columns in ((baselines.week_from_store(some), baselines.week_baseline(raw), ["connectup", "netflowup"]),
                                    (baselines.day_from_store(some), baselines.day_baseline(raw), ["connectavg", "netflowavg"])):
        a, b = ({tuple(r[k] for k in keys): [r[c] for c in columns] for r in df.collect()} for df in (stored_, plain))
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
