"""Skew-safe helpers give what the plain operators give, with a key that holds most rows."""

import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.operators import ports, skew
from flowlens.operators.joins import fold_reverse_flows, latest_records, merge_reverse_flows, with_group_size


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(40)}", rnd.randrange(100)) for i in range(3000)]
    rows += [(5000, None, 1), (5001, None, 2)]
    return spark.createDataFrame(rows, "id int, k string, v int").repartition(6).cache()


@pytest.mark.parametrize("hot_rows", [1, 200, 10**9])
def test_group_stats_equal_window(skewed, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    got = skew.with_group_stats(skewed, ["k"], "id", n=F.count(F.lit(1)), lo=F.min("v"))
    w = Window.partitionBy("k")
    want = skewed.select("*", F.count(F.lit(1)).over(w).alias("n"), F.min("v").over(w).alias("lo"))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / sum(counts)


def test_hot_key_is_spread_over_tasks(spark, skewed, monkeypatch):
    """60 % of the rows carry one key: a plain shuffled join or window puts them into one task, the helpers do not."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in changed}
    monkeypatch.setattr(skew, "HOT_ROWS", 200)
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        dim = skewed.groupBy("k").agg(F.max("v").alias("top"))
        assert largest_share(skewed.join(dim, "k")) > 0.6
        assert largest_share(skew.salted_lookup(skewed, dim, ["k"], "id")) < 0.3
        assert largest_share(skew.with_group_stats(skewed, ["k"], "id", n=F.count(F.lit(1)))) < 0.25
        pairs = skew.group_pairs(skewed.select("k", "id", "v").dropna(), "k", "id", "v", max_block=64)
        assert largest_share(pairs) < 0.25
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_only_hot_keys_are_copied(spark, monkeypatch):
    """200 tasks, 60 % of the rows on one key: no task gets more than 2 %, and only the hot key's row is copied."""
    rows = spark.range(20_000).selectExpr("id", "CASE WHEN id % 5 < 3 THEN 'hot' ELSE concat('k', id % 997) END AS k")
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in changed}
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        dim = rows.groupBy("k").agg(F.max("id").alias("top"))
        joined = skew.salted_lookup(rows, dim, ["k"], "id")
        assert joined.count() == 20_000 and largest_share(joined) <= 0.02
        hot = skew.hot_keys(rows, ["k"])
        assert [(r["__h_k"], r["__salts"]) for r in hot.collect()] == [("hot", 120)]
        copies = skew.with_salts(dim, hot, ["k"]).agg(F.sum("__salts")).first()[0]
        assert copies == dim.count() - 1 + 120
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_adaptive_execution_splits_the_hot_key(spark):
    """The same with the counting left to Spark: its split of the hot partition applies to an aggregate on the key, too."""
    rows = spark.range(200_000).selectExpr("id", "CASE WHEN id % 5 < 3 THEN 'hot' ELSE concat('k', id % 997) END AS k").repartition(20)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        dim = rows.groupBy("k").agg(F.max("id").alias("top"))
        assert skew.splits_skewed_joins(spark)
        joined = skew.salted_lookup(rows, dim, ["k"], "id").withColumn("p", F.spark_partition_id()).groupBy("p").count()
        assert joined.agg(F.max("count") / F.sum("count")).first()[0] < 0.1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_lookup_equals_join(spark, skewed, how):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, x int")
    got = skew.salted_lookup(skewed, dim, ["k"], "id", how)
    want = skewed.join(dim, "k", how)
    key = lambda r: r["id"]
    assert sorted([r.asDict() for r in got.collect()], key=key) == sorted([r.asDict() for r in want.collect()], key=key)


def test_lookup_adds_no_filter_on_the_salt(spark, skewed):
    """A salt that may be null makes Spark filter by it, with the key's whole expression, below the keyed aggregate."""
    facts = skewed.withColumn("key", F.concat(F.lit("k"), "k"))
    dim = facts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    out = skew.salted_lookup(facts, dim, ["key"], "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "xxhash64" in line]
    assert {(r.key, r.n) for r in out.select("key", "n").collect()} == {(r.key, r.n if r.key else None) for r in dim.collect()}


@pytest.mark.parametrize("block", [3, 10, 4096])
def test_group_pairs_equal_all_pairs(spark, block):
    groups = {"hot": 40, "a": 7, "b": 1, "c": 2}
    rows = [(g, f"m{i:02d}", float(i)) for g, n in groups.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, m string, v double")
    got = sorted((r.k, r.left, r.right, r.left_value, r.right_value) for r in skew.group_pairs(df, "k", "m", "v", max_block=block).collect())
    want = sorted(
        (g, f"m{i:02d}", f"m{j:02d}", float(i), float(j)) for g, n in groups.items() for i, j in itertools.combinations(range(n), 2)
    )
    assert got == want


def test_latest_records_keep_ties(spark):
    rows = [("a", 1, "TCP", 9), ("a", 2, "TCP", 1), ("a", 2, "UDP", 0), ("b", 5, None, 3)]
    df = spark.createDataFrame(rows, "ip string, t int, proto string, port int")
    got = {(r.ip, r.storagetime, r.p, r.q) for r in latest_records(df, "ip", "t", p=F.col("proto"), q=F.col("port")).collect()}
    assert got == {("a", 2, "UDP", 1), ("b", 5, None, 3)}


def test_group_size(skewed):
    sizes = {r.k: r.flownums for r in with_group_size(skewed, ["k"], "id").select("k", "flownums").distinct().collect()}
    assert sum(sizes.values()) == 3002 and sizes[None] == 2


def test_reverse_flows(spark):
    cols = "row string, recordtime int, srcip string, dstip string, srcport int, dstport int, proto string, costtime int, packernum int, bytesize int"
    rows = [
        ("f1", 1, "a", "b", 1000, 80, "TCP", 1, 10, 100),
        ("r1", 1, "b", "a", 80, 1000, "TCP", 2, 20, 200),
        ("r2", 1, "b", "a", 80, 1000, "TCP", 3, 30, 300),
        ("f2", 2, "a", "b", 1000, 80, "TCP", 1, 10, 100),
        ("eq", 1, "a", "b", 80, 80, "TCP", 1, 1, 1),
        ("none", 1, "a", "b", None, 80, "TCP", 1, 1, 1),
    ]
    got = sorted((r.row, r.costtime, r.packernum, r.bytesize) for r in merge_reverse_flows(spark.createDataFrame(rows, cols)).collect())
    assert got == [("f1", 3, 30, 300), ("f1", 4, 40, 400), ("f2", 1, 10, 100)]


def test_busy_ends_fold_without_pairs(spark):
    """Port baselines and verdicts of folded flows are those of the merged rows, and no row is written per pair of flows."""
    cols = "row string, srcip string, dstip string, srcport int, dstport int, proto string, recordtime timestamp_ntz, costtime int, packernum int, bytesize bigint"
    rnd, rows = random.Random(3), []
    at = [datetime(2001, 1, 1, h) for h in (1, 2)]

    def add(n, a, b, sp, dp):
        for _ in range(n):
            pk = rnd.choice([0, 1, 1, 2, 3, 40, None, -1])
            rows.append((f"r{len(rows)}", a, b, sp, dp, rnd.choice(["TCP", "UDP", None]), rnd.choice(at), rnd.randrange(9), pk, rnd.choice([None, *range(100, 5000, 700)])))

    add(150, "a", "b", 2000, 80), add(130, "b", "a", 80, 2000), add(12, "c", "b", 1050, 1018), add(9, "b", "c", 1018, 1050)
    add(5, "c", "c", 1050, 443), add(4, None, "b", 2000, 21), add(4, "b", None, 21, 2000), add(8, "a", "b", 2000, 21)
    flows = spark.createDataFrame(rows, cols).repartition(3).cache()
    merged, folded = merge_reverse_flows(flows).cache(), fold_reverse_flows(flows, ports.MOST_PACKETS).cache()
    assert merged.count() > 5000 and folded.count() < 1500 and folded.agg(F.sum("n_flows")).first()[0] == merged.count()
    text = lambda df: sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    for classify, baseline in ((ports.classify_ports, ports.port_baseline_3mean), (ports.classify_ports, ports.port_baseline_max),
                               (ports.classify_ports_simple, ports.port_baseline_3sigma)):
        assert text(baseline(classify(folded))) == text(baseline(classify(merged)))
    bounds = ports.port_baseline_3mean(ports.classify_ports(merged))
    want = ports.judge_ports(ports.classify_ports(merged), bounds)
    got = ports.judge_merged_ports(flows, folded, bounds)
    assert got.columns == want.columns and got.dtypes == want.dtypes and text(got) == text(want)
