"""Run registered queries beside their SQL and compare rows: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("TEST_DATA", "/root/testdata")


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, Decimal)):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, fn, oracle):
    """(message, rows, spark seconds); an empty message means equal."""
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - t0
    if oracle is None:
        return ("", len(got), spent)
    cur = con.execute(oracle)
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return (f"columns {sorted(df.columns)} != {sorted(cols)}", len(got), spent)
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if len(a) != len(b):
        return (f"rows {len(a)} != {len(b)}; first only here {next(iter(set(a) - set(b)), None)}, "
                f"first only there {next(iter(set(b) - set(a)), None)}", len(got), spent)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return (f"{len(bad)} rows differ, e.g. {bad[0]} of {sorted(cols)}", len(got), spent)
    return ("", len(got), spent)


def main(argv):
    import __spark_entry__ as entry
    from flowlens.session import local_session

    sf = argv[0] if argv else "0.01"
    names = argv[1:]
    sf_dir = f"{DATA}/sf{sf}"
    spark = local_session(scratch=tempfile.mkdtemp(prefix="flowlens-"))
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        try:
            msg, n, spent = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on
            msg, n, spent = f"{type(e).__name__}: {str(e)[:700]}", -1, 0.0
        failed += bool(msg)
        kind = "oracle" if name in oracles else "rows"
        print(f"{'FAIL' if msg else 'ok  '} {name:34s} {kind:6s} {n:8d} rows {spent:6.2f}s {msg}", flush=True)
        spark.catalog.clearCache()
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
