"""Row-level expressions on hand-made edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowlens.functions import flows as ff
from flowlens.functions import text as tx
from flowlens.functions.ip import in_ranges, ip_to_long, semi_join_ranges, text_to_long
from flowlens.functions.windows import day_folder, run_window


def values(df, column):
    return [r[column] for r in df.collect()]


def test_direction_codes(spark):
    rows = [("10.0.0.1", "8.8.8.8"), ("8.8.8.8", "10.0.0.1"), ("10.0.0.1", "10.0.0.2"), ("8.8.8.8", "9.9.9.9"), (None, "10.0.0.1"), ("x", "y")]
    df = spark.createDataFrame(rows, "s string, d string")
    got = values(df.select(ff.flow_direction(F.col("s"), F.col("d"), ["10.0.0"]).alias("f")), "f")
    assert got == ["0", "1", "2", "3", "1", "3"]


@pytest.mark.parametrize("hour,part", [(0, "midnight"), (7, "midnight"), (8, "morning"), (11, "morning"), (12, "noon"), (13, "noon"),
                                       (14, "afternoon"), (17, "afternoon"), (18, "night"), (23, "night")])
def test_time_of_day(spark, hour, part):
    df = spark.createDataFrame([(datetime(2024, 1, 1, hour, 59),)], "t timestamp")
    assert values(df.select(ff.time_of_day(F.col("t")).alias("p")), "p") == [part]


def test_time_of_day_of_null(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert values(df.select(ff.time_of_day(F.col("t")).alias("p")), "p") == [None]


def test_host_patterns(spark):
    hosts = ["a.b.c.d.com", "ads-track.example.org", "10.1.2.3", "example.com", "localhost", "my-host.com", "h.com:8080", "x"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    loose = values(df.select(tx.normalize_host(F.col("h")).alias("n")), "n")
    strict = values(df.select(tx.normalize_host(F.col("h"), strict=True).alias("n")), "n")
    assert loose == ["c.d.com", "track.example.org", "10.1.2.3", "example.com", "localhost", "my-host.com", "h.com:8080", ""]
    assert strict == ["c.d.com", "track.example.org", "10.1.2.3", "", "", "", "", ""]


def test_uri_tokens(spark):
    rows = [(1, "%zz?a=1"), (2, "a%3Fb%3D1"), (3, "?a=1"), (4, None), (5, "/a/b"), (6, "/x.php?id=1&n=a+b|c"), (7, "a?b")]
    df = spark.createDataFrame(rows, "id int, uri string")
    got = {r.id: r.urltext for r in tx.tokenize_uris(df).collect()}
    assert got == {2: "a ? b = 1", 3: "? a = 1", 6: "/ x . php ? id = 1 & n = a + b | c"}


def test_ip_numbers(spark):
    rows = ["10.0.0.1", "255.255.255.255", "1.2.3", "a.b.c.d", None, " 10.0.0.2 ", "10.10.01.00"]
    df = spark.createDataFrame([(r,) for r in rows], "ip string")
    got = values(df.select(ip_to_long(F.col("ip")).alias("n")), "n")
    assert got == [167772161, 4294967295, None, None, None, 167772162, 168427776]


def test_ranges_as_list_and_as_table(spark):
    rows = [("10.0.0.0",), ("10.0.0.255",), ("10.0.1.0",), ("10.3.0.5",), ("9.255.255.255",), ("bad",), (None,)]
    df = spark.createDataFrame(rows, "ip string")
    ranges = [("10.0.0.0", "10.0.0.255"), ("10.2.0.0", "10.4.0.0")]
    by_list = {r.ip for r in df.where(in_ranges(F.col("ip"), ranges)).collect()}
    table = spark.createDataFrame([(text_to_long(a), text_to_long(b)) for a, b in ranges], "lo bigint, hi bigint")
    by_table = {r.ip for r in semi_join_ranges(df, "ip", table, "ip").collect()}
    assert by_list == by_table == {"10.0.0.0", "10.0.0.255", "10.3.0.5"}


def test_dominant_feature(spark):
    rows = [(0.0, 0.0, 0.0), (0.5, 0.5, 0.1), (0.1, 0.2, 0.3), (-1.0, -2.0, -3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    name = ff.dominant_feature([F.col("a"), F.col("b"), F.col("c")], ["A", "B", "C"])
    assert values(df.select(name.alias("n")), "n") == ["", "A", "C", ""]


def test_attack_types(spark):
    rows = [(1.0, "TCP", 5, "CC"), (1.0, "UDP", 5, ""), (2.0, "UDP", 5, "UDPFlood"), (2.0, "TCP", 5, "SYNFlood"), (3.0, "TCP", 5, "SYNFlood"),
            (3.0, "UDP", 5, "UDPFlood"), (3.0, "ICMP", 5, ""), (4.0, "GRE", 1, "PORTSCAN"), (4.0, "TCP", 2, ""), (0.0, "TCP", 1, "")]
    df = spark.createDataFrame(rows, "p double, proto string, pk int, want string")
    out = df.select("want", ff.attack_type(F.col("p"), F.col("proto"), F.col("pk")).alias("got")).collect()
    assert [r.got for r in out] == [r.want for r in out]


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([(1.9, -1.9, 0.0)], "a double, b double, c double")
    packed = df.select(ff.pack_features([F.col("a"), F.col("b"), F.col("c")]).alias("p"))
    assert values(packed, "p") == ["1#-1#0"]
    row = packed.withColumns(ff.unpack_features(F.col("p"), ["x", "y", "z"])).first()
    assert (row.x, row.y, row.z) == ("1", "-1", "0")


def test_durations_and_sentinels(spark):
    rows = [("2024-01-01 00:00:00", "2024-01-01 00:00:01.500"), (None, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").selectExpr("cast(a as timestamp) a", "cast(b as timestamp) b")
    gap = ff.duration_ms(F.col("a"), F.col("b"))
    assert values(df.select(ff.missing_as_minus_one(gap).alias("d")), "d") == [1500, -1]


def test_old_http_filter_precedence(spark):
    rows = [("HTTP", "0"), ("HTTP", "1"), ("FTP", "2"), ("FTP", "0")]
    df = spark.createDataFrame(rows, "a string, f string")
    kept = [(r.a, r.f) for r in df.where(ff.old_http_filter(F.col("a"), F.col("f"))).collect()]
    assert kept == [("HTTP", "0"), ("FTP", "2")]


def test_epoch_text_and_shift(spark):
    df = spark.createDataFrame([(0,)], "t bigint")
    assert values(df.select(ff.epoch_text(F.col("t"), "s").alias("x")), "x") == ["1970-01-01 00:00:00"]
    moved = df.select(ff.time_text(ff.shift_hours(F.timestamp_seconds("t"), -8)).alias("x"))
    assert values(moved, "x") == ["1969-12-31 16:00:00"]


def test_record_id_is_stable(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, n int")
    ids = values(df.select(ff.record_id(F.col("k"), F.col("n")).alias("i")), "i")
    assert ids[0] == ids[1] != ids[2]


def test_run_windows():
    now = datetime(2024, 3, 1, 10, 20)
    assert run_window(now, "day") == (datetime(2024, 2, 29), datetime(2024, 3, 1))
    assert run_window(now, "hour") == (datetime(2024, 3, 1, 9), datetime(2024, 3, 1, 10))
    assert run_window(now, "week") == (datetime(2024, 2, 22), datetime(2024, 2, 28))
    assert run_window(now, "month") == (datetime(2024, 1, 30), datetime(2024, 3, 1))
    assert run_window(now, "day", start="2024-01-01")[0] == datetime(2024, 1, 1)
    assert day_folder(datetime(2024, 2, 29)) == "2024-02-29--2024-03-01"


def test_range_test_splits_an_address_once(spark):
    df = spark.createDataFrame([("10.0.0.7",), ("10.0.9.1",), ("x",), (None,)], "ip string")
    hits = df.where(in_ranges(F.concat("ip", F.lit("")), [("10.0.0.0", "10.0.0.255"), ("10.0.9.0", "10.0.9.9"), ("1.1.1.1", "1.1.1.2")]))
    assert values(hits, "ip") == ["10.0.0.7", "10.0.9.1"]
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
