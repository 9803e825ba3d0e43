"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

usage: python tools/oracle_check.py [--strict] [sf_dir] [name ...]
Prints one line per query: status, row counts, seconds.  Mirrors the driver's check
(row count + column names + order-insensitive values) with tolerant float rounding;
``--strict`` compares floats bit for bit.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


STRICT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if STRICT else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v) if STRICT else round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def sort_key(row):
    return tuple((x is None, repr(x)) for x in row)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    rows = [tuple(norm(x) for x in r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return f"NOSQL  {name:24s} spark={len(rows):8d}            {t1 - t0:6.1f}s"
    rel = con.sql(sql)
    ocols = list(rel.columns)
    orows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    t2 = time.time()
    if sorted(cols) != sorted(ocols):
        return f"COLS   {name:24s} spark={cols} oracle={ocols}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    a, b = sorted(rows, key=sort_key), sorted(orows, key=sort_key)
    status = "OK    " if a == b else "DIFF  "
    msg = f"{status} {name:24s} spark={len(rows):8d} oracle={len(orows):8d} {t1 - t0:6.1f}s {t2 - t1:6.1f}s"
    if a != b:
        sa, sb = set(a), set(b)
        msg += f"\n   only spark: {list(sa - sb)[:3]}\n   only oracle: {list(sb - sa)[:3]}"
    return msg


def main():
    global STRICT
    args = sys.argv[1:]
    if "--strict" in args:
        STRICT = True
        args = [a for a in args if a != "--strict"]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from driftwood.session import local_session
    from driftwood.plans import ORACLE, QUERIES
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            line = f"ERROR  {name:24s} {type(e).__name__}: {str(e)[:400]}"
        bad += not (line.startswith("OK") or line.startswith("NOSQL"))
        print(line, flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
