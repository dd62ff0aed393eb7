"""Port, flow, group and audit rules on hand-made rows."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowlens.operators import aggregates as agg
from flowlens.operators import audit, baselines, groups, ports
from flowlens.operators.joins import changed_flag, with_last_result
from flowlens.operators.scaling import min_max_scale, scale_zero_max
from flowlens.plans import jobs

T0 = datetime(2024, 1, 1, 3)
PORT_SCHEMA = (
    "row string, srcip string, dstip string, srcport int, dstport int, proto string, packernum int, bytesize int, costtime int, recordtime timestamp"
)


def flow(row, src, dst, sport, dport, proto, pk, by=1024):
    return (row, src, dst, sport, dport, proto, pk, by, 0, T0)


def classified(spark, rows, fn):
    # forty flows per common port keep those ports from being rare
    common = [flow(f"c{p}-{i}", "x", "b", 5000, p, "TCP", 5) for p in (22, 1024) for i in range(40)]
    out = fn(spark.createDataFrame(rows + common, PORT_SCHEMA)).where(~F.col("row").startswith("c"))
    return {(r.row, r.name): (r.port, r.abport, r["index"]) for r in out.collect()}


def test_port_classes(spark):
    rows = [
        flow("own", "b", "y", 777, 80, "TCP", 5),
        flow("own_udp", "b", "y", 777, 80, "UDP", 2),
        flow("low", "a", "b", 5000, 22, "TCP", 2),
        flow("low_one", "a", "b", 5000, 22, "TCP", 1),
        flow("low_gre", "a", "b", 5000, 22, "GRE", 2),
        flow("high", "a", "b", 5000, 1024, "TCP", 2),
        flow("high_udp", "a", "b", 5000, 1024, "UDP", 2),
        flow("edge", "a", "b", 5000, 1023, "TCP", 2),
        flow("rare2", "a", "b", 5000, 21, "TCP", 2),
        flow("rare3", "a", "b", 5000, 21, "TCP", 3),
        flow("web", "a", "b", 5000, 80, "TCP", 3),
        flow("web_tls", "a", "b", 5000, 443, "TCP", 2),
    ]
    got = classified(spark, rows, ports.classify_ports)
    assert got[("own", "b")] == ("777", "2", "other")
    assert got[("own_udp", "b")] == ("777", "3", "other")
    assert got[("low", "b")] == ("22", "3", "")
    assert got[("low", "a")] == ("5000", "2", "other")
    assert got[("low_one", "b")] == ("", "", "")
    assert got[("low_gre", "b")] == ("22", "0", "")
    assert got[("high", "b")] == ("1024", "1", "other")
    assert got[("high_udp", "b")] == ("1024", "3", "other")
    assert got[("edge", "b")] == ("1023", "1", "")
    assert got[("rare2", "b")] == ("21", "1", "")
    assert got[("rare3", "b")] == ("21", "1", "other")
    assert got[("web", "b")] == ("80", "3", "")
    assert got[("web_tls", "b")] == ("443", "3", "")


def test_port_rarity_without_shuffling_flows(spark):
    rows = [
        flow("often", "a", "b", 5000, 22, "TCP", 3), flow("rare", "a", "b", 5000, 21, "TCP", 3), flow("no_port", "a", "b", 5000, None, "TCP", 3),
        flow("no_source", None, "b", 5000, 21, "TCP", 3), flow("no_target", "a", None, 5000, 21, "TCP", 3), flow("twice", "a", "b", 5000, 21, "TCP", 3),
        flow("twice", "a", "b", 5000, 21, "TCP", 3), flow("self", "b", "b", 5000, 21, "TCP", 3),
    ]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were many flows
    try:
        got = classified(spark, rows, ports.classify_ports)
        plan = ports.classify_ports(spark.createDataFrame(rows, PORT_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert got == {
        ("often", "a"): ("5000", "2", "other"), ("often", "b"): ("22", "3", ""), ("rare", "a"): ("5000", "2", "other"),
        ("rare", "b"): ("21", "1", "other"), ("no_port", "a"): ("5000", "2", "other"), ("no_port", "b"): ("", "1", ""),
        ("no_source", None): ("21", "1", ""), ("no_source", "b"): ("21", "1", ""), ("no_target", "a"): ("5000", "2", "other"),
        ("no_target", None): ("21", "3", ""), ("twice", "a"): ("5000", "2", "other"), ("twice", "b"): ("21", "1", "other"),
        ("self", "b"): ("5000", "2", "other"),
    }


def test_port_classes_simple(spark):
    rows = [
        flow("own", "b", "y", 777, 80, "TCP", 5), flow("low", "a", "b", 5000, 22, "TCP", 2), flow("rare", "a", "b", 5000, 80, "TCP", 2),
        flow("rare_one", "a", "b", 5000, 80, "TCP", 1), flow("udp", "a", "b", 5000, 80, "UDP", 2), flow("gre", "a", "b", 5000, 22, "GRE", 9),
    ]
    got = classified(spark, rows, ports.classify_ports_simple)
    assert got[("own", "b")] == ("777", "2", "other")
    assert got[("low", "b")] == ("22", "3", "")
    assert got[("rare", "b")] == ("80", "1", "other")
    assert got[("rare_one", "b")] == ("80", "3", "")
    assert got[("udp", "b")] == ("80", "3", "")
    assert got[("gre", "b")] == ("22", "0", "")


def test_port_verdicts(spark):
    base = [("b", "22", "", 30.0, 3.0, "PORT"), ("b", "", "TCP", 30.0, 3.0, "PROTO"), ("b", "", "", 30.0, 3.0, "ALL")]
    baseline = spark.createDataFrame(base, "name string, port string, proto string, connectup double, netflowup double, baseline string")
    rows = [
        ("ok", "b", "22", "TCP", "3", "", 30, 3072), ("port", "b", "23", "TCP", "3", "", 1, 1), ("proto", "b", "22", "UDP", "3", "", 1, 1),
        ("both", "b", "23", "UDP", "3", "", 1, 1), ("bytes", "b", "22", "TCP", "3", "", 1, 3073), ("packets", "b", "22", "TCP", "3", "", 31, 1),
        ("marked", "b", "22", "TCP", "3", "other", 99, 9999), ("closed", "b", "99", "GRE", "2", "other", 1, 1), ("unknown", "z", "22", "TCP", "3", "", 1, 1),
    ]
    flows = spark.createDataFrame(rows, "row string, name string, port string, proto string, abport string, index string, packernum int, bytesize int")
    got = {r.row: r["index"] for r in ports.judge_ports(flows, baseline).collect()}
    assert got == {
        "ok": "normal", "port": "portabnormal", "proto": "protoabnormal", "both": "protoabnormal", "bytes": "netflowabnormal",
        "packets": "connectabnormal", "marked": "other", "closed": "other", "unknown": "protoabnormal",
    }


def test_port_bounds_of_known_size_are_not_shuffled_to(spark):
    rows = [flow(f"r{i}", "x", "b", 5000, 22, "UDP", 2 + (i % 2) * 2) for i in range(40)]
    found = ports.classify_ports(spark.createDataFrame(rows, PORT_SCHEMA))
    out = ports.judge_ports(found, ports.port_baseline_3mean(found))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    got = sorted((r.row, r.name, r.port, r["index"]) for r in out.collect())
    assert got == sorted([(f"r{i}", "b", "22", "normal") for i in range(40)] + [(f"r{i}", "x", "5000", "other") for i in range(40)])


def test_flow_verdicts_and_single_row_bounds(spark):
    cols = "srcip string, proto string, hour int, packernum int, bytesize int"
    week = spark.createDataFrame([("a", "TCP", 1, 10, 1024), ("b", "TCP", 1, 20, 2048), ("b", "TCP", 1, 20, 2048)], cols)
    bounds = {(r.name, r.baseline): (r.connectup, r.netflowup) for r in baselines.week_baseline(week).collect()}
    assert bounds[("b", "proto")] == (20.0, 2.0)
    assert bounds[("a", "all")] == pytest.approx((50.0, 5.0))  # one row: three times the overall mean
    day = spark.createDataFrame([("b", "TCP", 1, 20, 2048), ("b", "TCP", 1, 21, 2048), ("b", "TCP", 1, 21, 2049), ("b", "UDP", 1, 1, 1)], cols)
    day = day.withColumn("row", F.concat_ws("-", "proto", "packernum", "bytesize"))
    assert [r["index"] for r in baselines.judge_flows(day, baselines.week_baseline(week)).orderBy("proto", "bytesize", "packernum").collect()] == [
        "normal", "connectabnormal", "netflowabnormal", "protoabnormal"
    ]


def test_baseline_report_sentinels(spark):
    cols = "srcip string, proto string, hour int, packernum int, bytesize int"
    flows = spark.createDataFrame([("a", "TCP", 1, 10, 1024)], cols)
    day = baselines.baseline_report(baselines.day_baseline(flows), "daybaseline").first()
    week = baselines.baseline_report(baselines.week_baseline(flows), "weekbaseline").first()
    assert (day.connectdown, day.connectup, day.connectavg) == (-3.0, -3.0, 10.0)
    assert (week.connectdown, week.connectup, week.connectavg) == (-2.0, 30.0, -2.0)


def test_sigma_baseline_drops_single_rows(spark):
    rows = [flow(f"r{i}", "x", "b", 5000, 22, "UDP", 2 + (i % 2) * 2) for i in range(40)] + [flow("one", "x", "c", 5000, 22, "UDP", 2)]
    out = ports.port_baseline_3sigma(ports.classify_ports_simple(spark.createDataFrame(rows, PORT_SCHEMA)))
    got = {(r.name, r.baseline): (r.connectdown, r.connectup) for r in out.collect()}
    assert got[("b", "ALL")] == (0, 6) and ("c", "ALL") not in got


def test_quadrants_and_bounds(spark):
    rows = [(f"n{i}", 1.0, 1.0) for i in range(30)] + [("hi", 100.0, 100.0), ("hl", 9.0, 0.5), ("lh", 0.5, 9.0)]
    scored = spark.createDataFrame(rows, "ip string, proto double, flow double")
    got = {}
    for r in groups.quadrant_labels(scored).collect():
        got.setdefault(r.ip, []).append(r.label)
    assert sorted(got["hi"]) == ["other_high_flow", "other_high_proto"]
    assert got["hl"] == ["high_low"] and got["lh"] == ["low_high"] and got["n0"] == ["low_low"]


def test_values_at_the_mean_are_low(spark):
    scored = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0)], "ip string, proto double, flow double")
    assert {r.label for r in groups.quadrant_labels(scored).collect()} == {"low_low"}  # x = mean = mean + 3 sigma


def test_scaling_constants(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [(r.a_scl, r.b_scl) for r in min_max_scale(df, ("a", "b")).collect()] == [(0.5, 0.0), (0.5, 1.0)]
    zero = spark.createDataFrame([(0.0,), (0.0,)], "a double")
    assert [r.s for r in scale_zero_max(zero, "a", "s").collect()] == [0.0, 0.0]


def test_last_result_flags(spark):
    now = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "ip string, label string")
    last = spark.createDataFrame([("a", "x"), ("b", "x")], "ip string, label string")
    out = with_last_result(now, last).withColumns({"one": changed_flag(True), "zero": changed_flag(False)})
    assert {(r.ip, r.changed, r.one, r.zero) for r in out.collect()} == {("a", False, "1", "0"), ("b", True, "0", "1"), ("c", True, "0", "1")}
    first = with_last_result(now, None).first()
    assert first.last_label == "0" and not first.changed


def test_exact_median(spark):
    rnd = random.Random(5)
    for n in (1, 2, 9, 1000, 1001):
        xs = [rnd.random() for _ in range(n)]
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        s = sorted(xs)
        assert agg.exact_median(df, "x") == pytest.approx((s[(n - 1) // 2] + s[n // 2]) / 2)


LOGS = "row bigint, sourceip string, destip string, firstrecvtime bigint, eventname string, orglog string"


def audit_both_ways(logs):
    cols = [c for c in logs.columns]
    slow = audit.audit_rows(logs).select(*cols, "reach").distinct()
    fast = audit.audit_reach(logs).select(*cols, "reach")
    return sorted(map(tuple, slow.collect()), key=repr), sorted(map(tuple, fast.collect()), key=repr)


def test_audit_edges(spark):
    rows = [
        (1, "a", "b", 10_000, "SQL Injection x", "none"), (2, "a", "b", 10_999, "login", "run sql"), (3, "a", "b", 11_000, "login", "run sql"),
        (4, "c", "d", 0, "SQL Injection x", "sql"), (5, "e", "f", 0, "HTTP_SQL注入攻击", "x"), (6, "e", "f", 999, "login", "sql here"),
        (7, "e", "f", None, "SQL Injection y", "sql"), (8, None, "f", 5, "SQL Injection z", "sql"), (9, "g", "h", 59_500, "SQL Injection", "q"),
        (10, "g", "h", 60_100, "login", "sql"), (11, "e", "f", 5, "login", None),
    ]
    slow, fast = audit_both_ways(spark.createDataFrame(rows, LOGS))
    assert slow == fast
    reach = {}
    for r in fast:
        reach.setdefault(r[0], []).append(r[-1])
    assert reach[1] == ["0", "1"] and reach[4] == ["0"] and reach[8] == ["0"] and reach[9] == ["1"]


def test_audit_random_with_hot_pair(spark):
    rnd = random.Random(3)
    rows = [
        (i, "a" if rnd.random() < 0.5 else rnd.choice("xyz"), rnd.choice("pq"), rnd.randrange(400_000),
         rnd.choice(["SQL Injection", "login", "HTTP_SQL注入攻击"]), rnd.choice(["sql", "no"]))
        for i in range(700)
    ]
    slow, fast = audit_both_ways(spark.createDataFrame(rows, LOGS))
    assert slow == fast and len(fast) > 100


def test_repeated_flows(spark):
    rows = [("1", 1, "a", "b", "TCP", "1"), ("2", 1, "a", "b", "TCP", "1"), ("3", 1, "a", "b", "UDP", "1"), ("4", 1, "a", "b", "TCP", "0")]
    df = spark.createDataFrame(rows, "row string, recordtime int, srcip string, dstip string, proto string, flowd string")
    assert [r.row for r in jobs.repeated_flows(df).collect()] == ["2"]
