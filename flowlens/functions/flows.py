"""Column expressions for flow and audit records (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Protocols and methods with a 0/1 column of their own.
FLOW_PROTOCOLS = ("TCP", "UDP", "ICMP", "GRE")
APP_PROTOCOLS = ("HTTP", "QQ", "FTP", "TELNET", "DBAUDIT", "BDLOCALTROJAN")
HTTP_METHODS = ("GET", "POST")

# Direction codes.
IN_TO_OUT, OUT_TO_IN, IN_TO_IN, OUT_TO_OUT = "0", "1", "2", "3"


def one_hot(value: Column, names: tuple[str, ...], ignore_case: bool = True) -> dict[str, Column]:
    """0/1 column per name, keyed by the lower-case name."""
    v = F.upper(value) if ignore_case else value
    return {n.lower(): F.when(v == n, 1).otherwise(0) for n in names}


def network_prefix(ip: Column) -> Column:
    """First three octets."""
    return F.substring_index(ip, ".", 3)


def flow_direction(srcip: Column, dstip: Column, inner_prefixes: list[str]) -> Column:
    """Direction code from /24 membership of both ends."""
    src_in = F.coalesce(network_prefix(srcip).isin(inner_prefixes), F.lit(False))
    dst_in = F.coalesce(network_prefix(dstip).isin(inner_prefixes), F.lit(False))
    return (
        F.when(src_in & dst_in, IN_TO_IN).when(dst_in, OUT_TO_IN).when(src_in, IN_TO_OUT).otherwise(OUT_TO_OUT)
    )


def duration_ms(start: Column, end: Column) -> Column:
    """Milliseconds from start to end; null when either is missing."""
    return F.timestamp_diff("MILLISECOND", start, end)


def missing_as_minus_one(value: Column) -> Column:
    """Sentinel of the stored reports for 'unknown'."""
    return F.coalesce(value, F.lit(-1))


def epoch_text(value: Column, unit: str = "ms") -> Column:
    """Epoch number as ``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    ts = F.timestamp_millis(value) if unit == "ms" else F.timestamp_seconds(value)
    return time_text(ts)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def hour_label(ts: Column) -> Column:
    """Hour 0-23 as unpadded string."""
    return F.hour(ts).cast("string")


def time_of_day(ts: Column) -> Column:
    """Part of the day; null for a null time."""
    h = F.hour(ts)
    return (
        F.when(h < 8, "midnight").when(h < 12, "morning").when(h < 14, "noon").when(h < 18, "afternoon")
        .when(h < 24, "night")
    )


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def dominant_feature(values: list[Column], names: list[str]) -> Column:
    """Name of the first largest value above zero, '' if none is above zero."""
    best = F.greatest(*values)
    return reduce(
        lambda acc, vn: acc.when(vn[0] == best, vn[1]),
        list(zip(values, names)),
        F.when(F.coalesce(best, F.lit(0.0)) <= 0, ""),
    ).otherwise("")


def truncated(value: Column) -> Column:
    """Double to integer toward zero, equal in every SQL engine."""
    return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("bigint")


def pack_features(values: list[Column]) -> Column:
    """Integer-truncated values joined by '#'."""
    return F.concat_ws("#", *[truncated(v.cast("double")).cast("string") for v in values])


def unpack_features(packed: Column, names: list[str]) -> dict[str, Column]:
    parts = F.split(packed, "#")
    return {n: F.get(parts, F.lit(i)) for i, n in enumerate(names)}


def null_default(value: Column, default: str) -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def decimals(value: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f", value.cast("double"))


def attack_type(prediction: Column, proto: Column, packets: Column) -> Column:
    """Attack name of a model class, '' for no attack."""
    p, tcp, udp = prediction, proto == "TCP", proto == "UDP"
    return (
        F.when((p == 1) & tcp, "CC")
        .when(p.isin(2.0, 3.0) & udp, "UDPFlood")
        .when(p.isin(2.0, 3.0) & tcp, "SYNFlood")
        .when((p == 4) & (packets == 1), "PORTSCAN")
        .otherwise("")
    )


# Event names of an SQL injection.
INJECTION_NAME, INJECTION_PREFIX = "HTTP_SQL注入攻击", "SQL Injection"


def is_sql_injection(eventname: Column) -> Column:
    return (eventname == INJECTION_NAME) | eventname.startswith(INJECTION_PREFIX)


def has_http_host(appproto: Column, host: Column) -> Column:
    return (appproto == "HTTP") & host.isNotNull() & (host != "")


def old_http_filter(appproto: Column, flowd: Column) -> Column:
    """Earlier form of the HTTP filter: AND binds before OR."""
    return ((appproto == "HTTP") & (flowd == IN_TO_OUT)) | (flowd == IN_TO_IN)


def record_id(*keys: Column) -> Column:
    """Stable id of a record from its key columns."""
    return F.sha2(F.concat_ws("|", *[k.cast("string") for k in keys]), 256)


def add_batch(df: DataFrame, clno: str, cltime: str, **constants: str) -> DataFrame:
    """Batch id, batch time and further constants as columns."""
    cols = {"clno": F.lit(clno.replace("-", "")), "cltime": F.lit(cltime)}
    cols.update({k: F.lit(v) for k, v in constants.items()})
    return df.withColumns(cols)
