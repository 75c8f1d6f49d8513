"""Run catalogue queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tabspark.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            v = 0.0
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    vals = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, vals


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sn, sv = table(s_cols, s_rows)
    dn, dv = table(d_cols, d_rows)
    ok = sn == dn and sv == dv
    detail = ""
    if sn != dn:
        detail = f"columns spark={sn} duck={dn}"
    elif len(sv) != len(dv):
        detail = f"rows spark={len(sv)} duck={len(dv)}"
    elif sv != dv:
        diff = [(a, b) for a, b in zip(sv, dv) if a != b][:3]
        detail = f"values differ, e.g. {diff}"
    return ok, len(s_rows), t1 - t0, detail


def main(argv):
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    import __spark_entry__ as entry
    from tabspark.session import build_session
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = names or list(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            try:
                t0 = time.time()
                c = qs[n](spark, sf_dir).count()
                print(f"ROWS  {n:28s} rows={c} {time.time() - t0:.1f}s", flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {n:28s} {type(e).__name__}: {str(e)[:300]}", flush=True)
            continue
        try:
            ok, rows, secs, detail = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {n:28s} {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        bad += not ok
        print(f"{'OK   ' if ok else 'FAIL '} {n:28s} rows={rows} {secs:.1f}s {detail[:400]}", flush=True)
    print(f"failures: {bad} of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
