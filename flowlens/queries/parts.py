"""SQL of the logical inputs and of steps several queries share."""

from flowlens.functions.text import HOST_PATTERN
from flowlens.queries.registry import part

_PREFIX = "concat_ws('.', split_part({0}, '.', 1), split_part({0}, '.', 2), split_part({0}, '.', 3))"


def direction(src: str, dst: str, inner: str) -> str:
    s, d = f"{_PREFIX.format(src)} IN ({inner})", f"{_PREFIX.format(dst)} IN ({inner})"
    return f"CASE WHEN {s} AND {d} THEN '2' WHEN {d} THEN '1' WHEN {s} THEN '0' ELSE '3' END"


def port(n: str) -> str:
    return f"CASE WHEN {n} % 12 = 0 THEN 80 WHEN {n} % 12 = 1 THEN 443 ELSE 1016 + {n} % 12 END"


def address(key: str) -> str:
    a = f"(CASE {key} % 3 WHEN 0 THEN {key} % 4 WHEN 1 THEN {key} % 8 ELSE {key} END)"
    return f"concat('10.', {a} % 4, '.', ({a} // 256) % 256, '.', {a} % 256)"


INNER = "'10.0.0', '10.1.0'"
WIDE_INNER = ", ".join(f"'10.{a}.{b}'" for a in (0, 1) for b in range(4))
PRICE = "CAST(floor(l_extendedprice) AS BIGINT)"
PROTO = (
    "CASE WHEN CAST(l_quantity AS INT) % 10 < 5 THEN 'TCP' WHEN CAST(l_quantity AS INT) % 10 < 8 THEN 'UDP' "
    "WHEN CAST(l_quantity AS INT) % 10 = 8 THEN 'ICMP' ELSE 'GRE' END"
)
COST = "CAST(round(l_discount * 100) AS INT) * 10 + CAST(round(l_tax * 100) AS INT)"
TIME = "make_timestamp(CAST(year(l_shipdate) AS BIGINT), 1, 1, CAST(l_linenumber AS BIGINT), 0, 0.0)"
HOT = ", ".join(f"CASE WHEN upper(proto) = '{p}' THEN 1 ELSE 0 END AS {p.lower()}" for p in ("TCP", "UDP", "ICMP", "GRE"))

part("flows0", f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "row",
       {address('l_suppkey')} AS srcip, {address('l_partkey')} AS dstip,
       {port('l_orderkey')} AS srcport, {port(PRICE)} AS dstport, {PROTO} AS proto,
       CAST(l_quantity AS INT) AS packernum, {PRICE} AS bytesize, {COST} AS costtime, {TIME} AS recordtime,
       l_linenumber AS hour, CAST(l_linenumber % 5 AS DOUBLE) AS prediction
FROM lineitem""")
part("flows", f"SELECT *, {direction('srcip', 'dstip', INNER)} AS flowd FROM flows0", "flows0")
part("flows_hot", f"SELECT *, {HOT} FROM flows", "flows")

part("wide0", f"""
SELECT concat('10.', h % 4, '.', h // 256, '.', h % 256) AS srcip,
       concat('10.', 2 + (l_partkey % 50) % 2, '.0.', l_partkey % 50) AS dstip,
       {port('l_orderkey')} AS srcport, {port(PRICE)} AS dstport, {PROTO} AS proto,
       CAST(l_quantity AS INT) AS packernum, CASE WHEN l_suppkey = 5 THEN {PRICE} * 8 ELSE {PRICE} END AS bytesize,
       {COST} AS costtime, {TIME} AS recordtime
FROM (SELECT *, CASE WHEN l_partkey % 40 = 0 THEN 0 WHEN l_partkey % 3 = 0
             THEN (l_suppkey // 8) * 8 + l_suppkey % 2 ELSE l_suppkey END AS h FROM lineitem)""")
part("flows_wide", f"SELECT *, {HOT}, {direction('srcip', 'dstip', WIDE_INNER)} AS flowd FROM wide0", "wide0")

part("moniflow", f"""
SELECT e.event_id AS id, concat('10.', (user_id % 20) % 4, '.0.', user_id % 20) AS srcip,
       concat('10.', (event_id % 8) % 4, '.0.', event_id % 8) AS dstip,
       {port('user_id')} AS srcport, {port('event_id')} AS dstport,
       CASE WHEN event_type = 'error' THEN 'FTP' ELSE 'HTTP' END AS appproto,
       CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
       regexp_extract(p.url, '://([^/?#]+)', 1) AS host, regexp_extract(p.url, '://[^/?#]+(.*)$', 1) AS uri, e.ts AS date
FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)""")
part("audited", f"SELECT *, {direction('srcip', 'dstip', INNER)} AS flowd FROM moniflow", "moniflow")

_DAY_PART = (
    "CASE WHEN hour(date) < 8 THEN 'midnight' WHEN hour(date) < 12 THEN 'morning' WHEN hour(date) < 14 THEN 'noon' "
    "WHEN hour(date) < 18 THEN 'afternoon' ELSE 'night' END"
)
DAY_PART = _DAY_PART
part("visits", f"""
SELECT srcip AS ip, regexp_extract(host, '{HOST_PATTERN}', 1) AS host, hour(date) AS hour, {_DAY_PART} AS time
FROM moniflow WHERE appproto = 'HTTP' AND host IS NOT NULL AND host <> ''""", "moniflow")
part("ratings", """
SELECT srcip AS ip, host, CAST(count(*) AS DOUBLE) AS "count" FROM moniflow
WHERE appproto = 'HTTP' AND host <> '' GROUP BY srcip, host""", "moniflow")

part("genlog", """
SELECT event_id AS "row", concat('10.', (user_id % 8) % 4, '.0.', user_id % 8) AS sourceip,
       concat('10.', CAST(floor(user_id / 8) AS BIGINT) % 4, '.1.', CAST(floor(user_id / 8) AS BIGINT) % 4) AS destip,
       CAST(floor(epoch(ts)) AS BIGINT) AS firstrecvtime,
       CASE event_type WHEN 'error' THEN 'SQL Injection attempt' WHEN 'view' THEN 'HTTP_SQL注入攻击' ELSE 'login' END AS eventname,
       CASE WHEN event_type = 'click' THEN concat('run sql ', props) ELSE props END AS orglog
FROM events""")

part("raw_netflow", """
SELECT "row" AS recordid, lower(proto) AS proto, CAST(floor(epoch(recordtime)) AS BIGINT) AS recordtime,
       packernum AS uppkts, hour AS downpkts, bytesize AS ups, costtime AS downs, srcip, dstip, srcport, dstport,
       CAST(floor(epoch(recordtime)) AS BIGINT) AS starttime, CAST(floor(epoch(recordtime)) AS BIGINT) + costtime AS lasttime
FROM flows""", "flows")

part("stored", """
SELECT "row" AS "ROW", srcip AS "SRCIP", dstip AS "DSTIP",
       CASE WHEN packernum > 2 THEN strftime(recordtime, '%Y-%m-%d %H:%M:%S') END AS "STARTTIME",
       CASE WHEN costtime > 0 THEN strftime(recordtime, '%Y-%m-%d %H:%M:%S') ELSE 'not a time' END AS "ENDTIME",
       CASE WHEN srcport = 80 THEN '-1' ELSE CAST(srcport AS VARCHAR) END AS "SRCPORT",
       CASE WHEN dstport = 443 THEN '' ELSE CAST(dstport AS VARCHAR) END AS "DSTPORT", proto AS "PROTO",
       concat(packernum, '.0') AS "PACKERNUM", CAST(bytesize AS VARCHAR) AS "BYTESIZE",
       strftime(recordtime, '%Y-%m-%d %H:%M:%S') AS "RECORDTIME"
FROM flows""", "flows")

part("register", f"""
SELECT {address('s_suppkey')} AS ip,
       CASE WHEN s_suppkey % 8 IN (0, 1) THEN 1 ELSE 2 END AS status FROM supplier""")
part("found", f"""
SELECT {address('c_custkey')} AS ip,
       CASE WHEN c_custkey % 8 = 2 THEN 0 ELSE 1 END AS flg FROM customer""")
part("known", "SELECT ip FROM register WHERE status <> 2 UNION SELECT ip FROM found WHERE flg <> 1", "register", "found")

part("points", "SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings")

# -- groups of the wide flows ----------------------------------------------------------------------------------------
SEVEN = ("tcp", "udp", "icmp", "gre", "costtime", "packernum", "bytesize")
part("own", """
SELECT CASE WHEN flowd IN ('0', '2') THEN srcip ELSE dstip END AS ip, flowd, tcp, udp, icmp, gre, costtime, packernum, bytesize
FROM flows_wide WHERE flowd IN ('0', '1', '2')""", "flows_wide")
part("totals", "SELECT ip, " + ", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}" for f in SEVEN) + " FROM own GROUP BY ip", "own")
part("scaled", "SELECT *, " + ", ".join(
    f"CASE WHEN max({f}) OVER () = min({f}) OVER () THEN 0.5 ELSE "
    f"CAST({f} - min({f}) OVER () AS DOUBLE) / (max({f}) OVER () - min({f}) OVER ()) END AS {f}_scl" for f in SEVEN
) + " FROM totals", "totals")
part("scored", """
SELECT *, 0.25::DOUBLE * tcp_scl + 0.25::DOUBLE * udp_scl + 0.25::DOUBLE * icmp_scl + 0.25::DOUBLE * gre_scl AS proto,
       0.33::DOUBLE * costtime_scl + 0.33::DOUBLE * packernum_scl + 0.33::DOUBLE * bytesize_scl AS flow FROM scaled""", "scaled")
part("bounds", """
SELECT avg(proto) AS p, avg(flow) AS f, avg(proto) + 3 * stddev_pop(proto) AS p_hi, avg(flow) + 3 * stddev_pop(flow) AS f_hi
FROM scored""", "scored")
part("labelled", """
SELECT s.*, 'other_high_proto' AS label FROM scored s, bounds WHERE proto > p_hi
UNION ALL SELECT s.*, 'other_high_flow' FROM scored s, bounds WHERE flow > f_hi
UNION ALL SELECT s.*, concat(CASE WHEN proto > p THEN 'high' ELSE 'low' END, '_', CASE WHEN flow > f THEN 'high' ELSE 'low' END)
FROM scored s, bounds WHERE NOT (proto > p_hi OR flow > f_hi)""", "scored", "bounds")
part("group_means", "SELECT label, " + ", ".join(f"avg({f}) AS {f}_mean" for f in SEVEN)
     + " FROM labelled WHERE label NOT LIKE 'other%' GROUP BY label", "labelled")
part("group_max", "SELECT " + ", ".join(f"max({f}) AS {f}_max" for f in SEVEN) + " FROM labelled", "labelled")
part("grouped", "SELECT l.ip, l.label, " + ", ".join(SEVEN) + ", concat_ws('#', " + ", ".join(SEVEN) + ") AS features, "
     + "CASE WHEN l.label LIKE 'other%' THEN '0' ELSE concat_ws('#', "
     + ", ".join(f"CAST(floor(round({f}_mean, 6)) AS BIGINT)" for f in SEVEN) + ") END AS center, "
     + "CASE WHEN l.label LIKE 'other%' THEN 0.0 ELSE sqrt("
     + " + ".join(f"pow({f}_scl - CASE WHEN {f}_max = 0 THEN 0 ELSE {f}_mean / {f}_max END, 2)" for f in SEVEN)
     + ") END AS distance FROM labelled l LEFT JOIN group_means m ON l.label = m.label CROSS JOIN group_max",
     "labelled", "group_means", "group_max")

# -- port portraits ---------------------------------------------------------------------------------------------------


def _classify(name: str, source: str, simple: bool) -> None:
    limit = "30" if simple else f"(SELECT greatest(10, CAST(floor(count(*) * 0.00375::DOUBLE) AS BIGINT)) FROM {source})"
    part(f"{name}_rare", f"SELECT dstip, dstport FROM {source} GROUP BY dstip, dstport HAVING count(dstport) < {limit}", source)
    part(f"{name}_rows", f"""
SELECT f.*, e.name, r.dstport IS NOT NULL AS rare, f.srcip = e.name AS outgoing
FROM {source} f LEFT JOIN {name}_rare r ON f.dstip = r.dstip AND f.dstport = r.dstport,
     LATERAL (SELECT f.srcip AS name UNION SELECT f.dstip) e""", source, f"{name}_rare")
    if simple:
        noticed = "rare AND NOT outgoing AND proto = 'TCP' AND packernum >= 2"
        first = f"CASE WHEN outgoing THEN '2' WHEN {noticed} THEN '1' ELSE '0' END"
        ports = "CAST(CASE WHEN outgoing THEN srcport ELSE dstport END AS VARCHAR)"
        other = f"outgoing OR ({noticed})"
    else:
        noticed = "rare AND NOT outgoing AND proto = 'TCP' AND packernum >= 3 AND dstport NOT IN (80, 443)"
        first = (
            f"CASE WHEN {noticed} THEN '1' WHEN outgoing THEN '2' WHEN dstport < 1024 AND packernum >= 2 THEN "
            "CASE WHEN rare AND dstport NOT IN (80, 443) THEN '1' ELSE '0' END WHEN packernum >= 2 THEN '1' ELSE '' END"
        )
        ports = "CASE WHEN outgoing THEN CAST(srcport AS VARCHAR) WHEN packernum >= 2 THEN CAST(dstport AS VARCHAR) ELSE '' END"
        other = f"outgoing OR ({noticed}) OR (dstport >= 1024 AND packernum >= 2)"
    part(f"{name}_first", f"""
SELECT *, {ports} AS port, {first} AS class1, CASE WHEN {other} THEN 'other' ELSE '' END AS "index" FROM {name}_rows""", f"{name}_rows")
    part(name, f"""
SELECT *, CASE WHEN (class1 = '0' AND proto = 'TCP') OR (proto = 'UDP' AND packernum >= 2) THEN '3' ELSE class1 END AS abport
FROM {name}_first""", f"{name}_first")


part("port_flows", """
SELECT * REPLACE (CASE bytesize % 251 WHEN 0 THEN 21 WHEN 1 THEN 22 WHEN 2 THEN 8080 WHEN 3 THEN 2000 ELSE
  CASE WHEN dstip = '10.3.0.7' AND dstport = 443 AND bytesize % 251 > 20 THEN 1018 ELSE dstport END END AS dstport) FROM flows""", "flows")
_classify("classified", "port_flows", False)
_classify("classified_simple", "port_flows", True)


def open_lists(name: str) -> None:
    part(f"{name}_open_ports", f"SELECT DISTINCT name, port FROM {name} WHERE abport = '3' AND port <> ' '", name)
    part(f"{name}_open_protos", f"SELECT DISTINCT name, proto FROM {name} WHERE abport = '3' AND proto <> ' '", name)


def half_up(value: str) -> str:
    """Two decimals, half up, as the decimal type rounds."""
    return f"CAST(round(CAST({value} AS DECIMAL(30, 6)), 2) AS DOUBLE)"


def three_mean(name: str) -> None:
    """Bounds of three means of a classified table, as ``<name>_mean``."""
    open_lists(name)
    part(f"{name}_levels", f"""
SELECT name, CASE WHEN grouping(port) = 0 THEN port ELSE '' END AS port, CASE WHEN grouping(proto) = 0 THEN proto ELSE '' END AS proto,
       {half_up('3 * avg(packernum)')} AS connectup, {half_up('3 * avg(bytesize) / 1024')} AS netflowup,
       CASE WHEN grouping(port) = 0 AND grouping(proto) = 0 THEN 'PORTPROTO' WHEN grouping(port) = 0 THEN 'PORT'
            WHEN grouping(proto) = 0 THEN 'PROTO' ELSE 'ALL' END AS baseline
FROM {name} GROUP BY GROUPING SETS ((name), (name, port), (name, proto), (name, port, proto))""", name)
    part(f"{name}_mean", f"""
SELECT * FROM {name}_levels l
WHERE (baseline IN ('ALL', 'PROTO') OR EXISTS (SELECT 1 FROM {name}_open_ports o WHERE o.name = l.name AND o.port = l.port))
  AND (baseline IN ('ALL', 'PORT') OR EXISTS (SELECT 1 FROM {name}_open_protos o WHERE o.name = l.name AND o.proto = l.proto))""",
         f"{name}_levels", f"{name}_open_ports", f"{name}_open_protos")


three_mean("classified")


def judged(name: str, today: str, bounds: str) -> None:
    part(name, f"""
SELECT t.name, t."row", t.srcip, t.dstip, t.proto, t.port, t.abport, t.packernum, t.bytesize,
       CASE WHEN abport <> '3' THEN "index"
            WHEN NOT EXISTS (SELECT 1 FROM {bounds} b WHERE b.baseline = 'PROTO' AND b.name = t.name AND b.proto = t.proto) THEN 'protoabnormal'
            WHEN NOT EXISTS (SELECT 1 FROM {bounds} b WHERE b.baseline = 'PORT' AND b.name = t.name AND b.port = t.port) THEN 'portabnormal'
            WHEN "index" <> '' THEN "index"
            WHEN t.bytesize / 1024.0 > a.netflowup THEN 'netflowabnormal'
            WHEN t.packernum > a.connectup THEN 'connectabnormal' ELSE 'normal' END AS "index"
FROM {today} t LEFT JOIN {bounds} a ON a.baseline = 'ALL' AND a.name = t.name""", today, bounds)


# history and current flows, both directions merged
for _name, _cond in (("history", "recordtime <= TIMESTAMP '2000-12-31 23:59:59'"), ("current", "recordtime >= TIMESTAMP '2001-01-01 00:00:00'")):
    part(f"{_name}_flows", f"SELECT * FROM flows WHERE {_cond}", "flows")
    part(f"{_name}_ports", f"SELECT * FROM port_flows WHERE {_cond}", "port_flows")
    part(f"{_name}_merged", f"""
SELECT l."row", l.srcip, l.dstip, l.srcport, l.dstport, l.proto, l.recordtime, l.hour, l.flowd,
       coalesce(l.packernum + r.packernum, l.packernum) AS packernum, coalesce(l.bytesize + r.bytesize, l.bytesize) AS bytesize,
       coalesce(l.costtime + r.costtime, l.costtime) AS costtime
FROM {_name}_ports l LEFT JOIN {_name}_ports r ON l.recordtime = r.recordtime AND l.srcip = r.dstip AND l.dstip = r.srcip
     AND l.srcport = r.dstport AND l.dstport = r.srcport WHERE l.srcport > l.dstport""", f"{_name}_ports")
    _classify(f"{_name}_classified", f"{_name}_merged", False)
three_mean("history_classified")
part("merged", """
SELECT l."row", l.srcip, l.dstip, l.srcport, l.dstport, l.proto, l.recordtime, l.hour, l.flowd,
       coalesce(l.packernum + r.packernum, l.packernum) AS packernum, coalesce(l.bytesize + r.bytesize, l.bytesize) AS bytesize,
       coalesce(l.costtime + r.costtime, l.costtime) AS costtime
FROM port_flows l LEFT JOIN port_flows r ON l.recordtime = r.recordtime AND l.srcip = r.dstip AND l.dstip = r.srcip
     AND l.srcport = r.dstport AND l.dstport = r.srcport WHERE l.srcport > l.dstport""", "port_flows")
_classify("merged_simple", "merged", True)
judged("judged", "classified", "classified_mean")
judged("portrait", "current_classified", "history_classified_mean")


def sigma(name: str) -> None:
    def bound(column: str, sign: str) -> str:
        value = f"round(avg({column}) {sign} 3 * stddev_samp({column}), 6)"
        return f"CAST(floor({'greatest(0, ' + value + ')' if sign == '-' else value}) AS BIGINT)"

    part(f"{name}_sigma", f"""
SELECT name, CASE WHEN grouping(port) = 0 THEN port ELSE '' END AS port, CASE WHEN grouping(proto) = 0 THEN proto ELSE '' END AS proto,
       CAST(hour AS VARCHAR) AS hour, {bound('packernum', '-')} AS connectdown, {bound('packernum', '+')} AS connectup,
       {bound('bytesize', '-')} AS netflowdown, {bound('bytesize', '+')} AS netflowup,
       CASE WHEN grouping(port) = 0 AND grouping(proto) = 0 THEN 'PORTPROTO' WHEN grouping(port) = 0 THEN 'PORT'
            WHEN grouping(proto) = 0 THEN 'PROTO' ELSE 'ALL' END AS baseline
FROM {name} WHERE abport = '3'
GROUP BY GROUPING SETS ((name, hour), (name, port, hour), (name, proto, hour), (name, port, proto, hour))
HAVING stddev_samp(packernum) IS NOT NULL""", name)


sigma("classified_simple")
sigma("merged_simple")

# -- week bounds ------------------------------------------------------------------------------------------------------


def week(name: str, source: str) -> None:
    part(name, f"""
SELECT srcip AS name, CASE WHEN grouping(proto) = 0 THEN proto ELSE '' END AS proto, hour,
       coalesce(avg(packernum) + 3 * stddev_samp(packernum), 3 * (SELECT avg(packernum) FROM {source})) AS connectup,
       coalesce(avg(bytesize / 1024.0) + 3 * stddev_samp(bytesize / 1024.0), 3 * (SELECT avg(bytesize / 1024.0) FROM {source})) AS netflowup,
       CASE WHEN grouping(proto) = 0 THEN 'proto' ELSE 'all' END AS baseline
FROM {source} GROUP BY GROUPING SETS ((srcip, proto, hour), (srcip, hour))""", source)


week("week", "flows")
week("history_week", "history_flows")
