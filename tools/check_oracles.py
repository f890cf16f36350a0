"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/check_oracles.py [sf_dir] [name ...]
Prints one line per query: rows, column names and value equality.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v  # exact: the driver hashes values
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(records):
    out = [tuple(_norm(x) for x in r) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"{name:28s} spark rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s"
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = rows_of([tuple(r[i] for i in order_s) for r in s_rows])
    b = rows_of([tuple(r[i] for i in order_d) for r in d_rows])
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_vals = a == b
    msg = f"{name:28s} rows {len(s_rows)}/{len(d_rows)} cols={'ok' if ok_cols else (s_cols, d_cols)} values={'EQUAL' if ok_vals else 'DIFF'} spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"
    if not ok_vals:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        msg += f"\n    first diffs: {diff}"
    return msg


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from tessera.plans.registry import load_all
    from tessera.session import build_session

    queries, oracles = load_all()
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    names = args or list(queries)
    for n in names:
        try:
            print(compare(spark, con, n, queries[n], oracles.get(n), sf_dir), flush=True)
        except Exception as e:  # report and continue
            print(f"{n:28s} ERROR {type(e).__name__}: {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main()
