"""Compare registered Spark queries with their DuckDB oracles.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  Prints one
line per query (rows, schema and an order-insensitive value hash) and a
summary; exits non-zero when any query with an oracle mismatches.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hirelake.sources.testdata import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from hirelake.session import build_session

    spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and continue
            print(f"{name:32s} SPARK-ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} rows={len(s_rows):7d} (no oracle) spark={t1 - t0:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as exc:
            print(f"{name:32s} ORACLE-ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        hs, hd = digest(s_cols, s_rows), digest(d_cols, d_rows)
        ok = ok_cols and len(s_rows) == len(d_rows) and hs == hd
        bad += 0 if ok else 1
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={len(s_rows)}/{len(d_rows)} "
              f"cols={'ok' if ok_cols else (sorted(s_cols), sorted(d_cols))} "
              f"hash={hs}/{hd} spark={t1 - t0:.1f}s")
    print(f"mismatches={bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
