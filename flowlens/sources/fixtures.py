"""Logical inputs derived from the supplied tables by column formulas (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.flows import flow_direction, one_hot, FLOW_PROTOCOLS

INNER = ["10.0.0", "10.1.0"]
WIDE_INNER = [f"10.{a}.{b}" for a in (0, 1) for b in range(4)]
ASSET_RANGES = [("10.0.0.0", "10.1.0.255")]
# The newest year of the flow table is the day under judgement, the years before are its history.
HISTORY = ("1990-01-01 00:00:00", "2000-12-31 23:59:59")
CURRENT = ("2001-01-01 00:00:00", "2099-12-31 23:59:59")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ip(number: Column, third: str = "0") -> Column:
    return F.concat(F.lit("10."), (number % 4).cast("string"), F.lit(f".{third}."), number.cast("string"))


def _address(key: Column) -> Column:
    """Address of a key: the addresses grow with the keys, but two thirds of the keys share eight, half of these four."""
    a = F.when(key % 3 == 0, key % 4).when(key % 3 == 1, key % 8).otherwise(key)
    text = lambda c: c.cast("string")
    return F.concat(F.lit("10."), text(a % 4), F.lit("."), text(F.floor(a / 256) % 256), F.lit("."), text(a % 256))


def _port(number: Column) -> Column:
    p = (number % 12).cast("int")
    return F.when(p == 0, 80).when(p == 1, 443).otherwise(1016 + p)


def _proto(quantity: Column) -> Column:
    q = quantity.cast("int") % 10
    return F.when(q < 5, "TCP").when(q < 8, "UDP").when(q == 8, "ICMP").otherwise("GRE")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared flow records."""
    li = table(spark, sf_dir, "lineitem")
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    price = F.floor("l_extendedprice").cast("bigint")
    base = li.select(
        F.concat_ws("-", *key).alias("row"),
        _address(F.col("l_suppkey")).alias("srcip"),
        _address(F.col("l_partkey")).alias("dstip"),
        _port(F.col("l_orderkey")).alias("srcport"),
        _port(price).alias("dstport"),
        _proto(F.col("l_quantity")).alias("proto"),
        F.col("l_quantity").cast("int").alias("packernum"),
        price.alias("bytesize"),
        (F.round(F.col("l_discount") * 100).cast("int") * 10 + F.round(F.col("l_tax") * 100).cast("int")).alias("costtime"),
        F.expr("make_timestamp_ntz(year(l_shipdate), 1, 1, l_linenumber, 0, 0)").alias("recordtime"),
        F.col("l_linenumber").alias("hour"),
        (F.col("l_linenumber") % 5).cast("double").alias("prediction"),
    )
    return base.withColumn("flowd", flow_direction(F.col("srcip"), F.col("dstip"), INNER))


def port_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records with some seldom used destination ports (and asset 7 seldom reached on 443)."""
    f = flows(spark, sf_dir)
    k = F.col("bytesize") % 251
    port = (
        F.when(k == 0, 21).when(k == 1, 22).when(k == 2, 8080).when(k == 3, 2000)
        .when((F.col("dstip") == "10.3.0.7") & (F.col("dstport") == 443) & (k > 20), 1018).otherwise(F.col("dstport"))
    )
    return f.withColumn("dstport", port)


def flows_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records of many assets, with 0/1 protocol columns."""
    li = table(spark, sf_dir, "lineitem")
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    h = (
        F.when(p % 40 == 0, F.lit(0).cast("bigint"))
        .when(p % 3 == 0, F.expr("(l_suppkey div 8) * 8 + l_suppkey % 2"))
        .otherwise(s)
    )
    text = lambda c: c.cast("string")
    g = p % 50
    price = F.floor("l_extendedprice").cast("bigint")
    proto = _proto(F.col("l_quantity"))
    base = li.withColumn("h", h).select(
        F.concat(F.lit("10."), text(F.col("h") % 4), F.lit("."), text(F.expr("h div 256")), F.lit("."),
                 text(F.col("h") % 256)).alias("srcip"),
        F.concat(F.lit("10."), text(2 + g % 2), F.lit(".0."), text(g)).alias("dstip"),
        _port(F.col("l_orderkey")).alias("srcport"),
        _port(price).alias("dstport"),
        proto.alias("proto"),
        F.col("l_quantity").cast("int").alias("packernum"),
        F.when(s == 5, price * 8).otherwise(price).alias("bytesize"),
        (F.round(F.col("l_discount") * 100).cast("int") * 10 + F.round(F.col("l_tax") * 100).cast("int")).alias("costtime"),
        F.expr("make_timestamp_ntz(year(l_shipdate), 1, 1, l_linenumber, 0, 0)").alias("recordtime"),
    )
    hot = one_hot(F.col("proto"), FLOW_PROTOCOLS)
    return base.withColumns({**hot, "flowd": flow_direction(F.col("srcip"), F.col("dstip"), WIDE_INNER)})


def moniflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application audit records."""
    ev, pages = table(spark, sf_dir, "events"), table(spark, sf_dir, "pages").select("page_id", "url")
    n = pages.agg(F.count(F.lit(1))).scalar()
    joined = ev.withColumn("__page", F.col("event_id") % n).join(pages, F.col("__page") == F.col("page_id"))
    return joined.select(
        F.col("event_id").alias("id"),
        _ip(F.col("user_id") % 20).alias("srcip"),
        _ip(F.col("event_id") % 8).alias("dstip"),
        _port(F.col("user_id")).alias("srcport"),
        _port(F.col("event_id")).alias("dstport"),
        F.when(F.col("event_type") == "error", "FTP").otherwise("HTTP").alias("appproto"),
        F.when(F.col("event_type") == "purchase", "POST").otherwise("GET").alias("method"),
        F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", "://[^/?#]+(.*)$", 1).alias("uri"),
        F.col("ts").alias("date"),
    )


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit records with their direction."""
    df = moniflow(spark, sf_dir)
    return df.withColumn("flowd", flow_direction(F.col("srcip"), F.col("dstip"), INNER))


def genlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General event log; whole epoch seconds stand in for milliseconds."""
    ev = table(spark, sf_dir, "events")
    w = F.floor(F.col("user_id") / 8).cast("bigint") % 4
    kind = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("row"),
        _ip(F.col("user_id") % 8).alias("sourceip"),
        F.concat(F.lit("10."), w.cast("string"), F.lit(".1."), w.cast("string")).alias("destip"),
        F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("firstrecvtime"),
        F.when(kind == "error", "SQL Injection attempt").when(kind == "view", "HTTP_SQL注入攻击").otherwise("login").alias("eventname"),
        F.when(kind == "click", F.concat(F.lit("run sql "), F.col("props"))).otherwise(F.col("props")).alias("orglog"),
    )


def raw_netflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index layout before preparation: lower-case protocol, counts per direction, epoch seconds."""
    f = flows(spark, sf_dir)
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', recordtime)")
    return f.select(
        F.col("row").alias("recordid"), F.lower("proto").alias("proto"), seconds.alias("recordtime"),
        F.col("packernum").cast("bigint").alias("uppkts"), F.col("hour").cast("bigint").alias("downpkts"),
        F.col("bytesize").alias("ups"), F.col("costtime").cast("bigint").alias("downs"),
        "srcip", "dstip", "srcport", "dstport",
        seconds.alias("starttime"), (seconds + F.col("costtime")).alias("lasttime"),
    )


def stored_netflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog layout as strings, with missing and unreadable cells."""
    f = flows(spark, sf_dir)
    t = F.date_format("recordtime", "yyyy-MM-dd HH:mm:ss")
    return f.select(
        F.col("row").alias("ROW"), F.col("srcip").alias("SRCIP"), F.col("dstip").alias("DSTIP"),
        F.when(F.col("packernum") > 2, t).alias("STARTTIME"),
        F.when(F.col("costtime") > 0, t).otherwise("not a time").alias("ENDTIME"),
        F.when(F.col("srcport") == 80, "-1").otherwise(F.col("srcport").cast("string")).alias("SRCPORT"),
        F.when(F.col("dstport") == 443, "").otherwise(F.col("dstport").cast("string")).alias("DSTPORT"),
        F.col("proto").alias("PROTO"),
        F.concat(F.col("packernum").cast("string"), F.lit(".0")).alias("PACKERNUM"),
        F.col("bytesize").cast("string").alias("BYTESIZE"),
        t.alias("RECORDTIME"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per address and host of the HTTP audit records."""
    df = moniflow(spark, sf_dir).where((F.col("appproto") == "HTTP") & (F.col("host") != ""))
    return df.groupBy(F.col("srcip").alias("ip"), "host").agg(F.count(F.lit(1)).cast("double").alias("count"))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with given labels: vec_id, label, vector as doubles."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def asset_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered devices: one per supplier; those ending in 0 or 1 are in service (status 1)."""
    k = F.col("s_suppkey") % 8
    s = table(spark, sf_dir, "supplier")
    return s.select(_address(F.col("s_suppkey")).alias("ip"), F.when(k.isin(0, 1), 1).otherwise(2).alias("status"))


def assets_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices found before: one per customer; those ending in 2 are still open (flag 0)."""
    k = F.col("c_custkey") % 8
    c = table(spark, sf_dir, "customer")
    return c.select(_address(F.col("c_custkey")).alias("ip"), F.when(k == 2, 0).otherwise(1).alias("flg"))


def labelled_flows(spark: SparkSession, sf_dir: str, which: Column | None = None) -> DataFrame:
    """Training layout of the chosen flows; the class follows from protocol, packets and bytes."""
    f = flows(spark, sf_dir)
    f = f if which is None else f.where(which)
    cls = (
        F.when(F.col("packernum") <= 2, 4).when((F.col("proto") == "UDP") & (F.col("bytesize") > 40000), 2)
        .when((F.col("proto") == "TCP") & (F.col("bytesize") > 60000), 1).when(F.col("proto") == "TCP", 0).otherwise(3)
    )
    hot = one_hot(F.col("proto"), FLOW_PROTOCOLS)
    return f.withColumns(hot).select(
        cls.cast("string").alias("attacktype"), F.col("costtime").alias("spandtime"), "tcp", "udp", "packernum",
        "bytesize", F.lit("2").alias("flowdirection"), F.lit("0").alias("same"), F.col("row").alias("recordid"),
        "srcip", "dstip",
    )


def url_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts to classify."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.regexp_replace("text", "\\s+", " ").alias("urltext"))


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts: quality 0 stands for an attack, 1 for normal."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return url_texts(spark, sf_dir).join(lab, "doc_id").select("doc_id", "label", "urltext")
