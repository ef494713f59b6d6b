"""Compare registered queries with their SQL, the way a reviewer would: columns by name, rows as a bag."""

import glob
import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6g}" if abs(v) >= 1e6 else f"{v:.6f}"
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return datetime(v.year, v.month, v.day).isoformat()
    return str(v)


def rows_as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(c for c in columns), Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def check(spark, con, sf_dir, name, fn, sql):
    """(ok, message, seconds) for one query."""
    t = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_as_bag(df.columns, df.collect())
    took = time.time() - t
    if sql is None:
        return True, f"{sum(got.values())} rows, no SQL", took
    result = con.execute(sql)
    want_cols, want = rows_as_bag([c[0] for c in result.description], result.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}", took
    if got != want:
        extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
        return False, f"{sum(got.values())} vs {sum(want.values())} rows; only spark {extra}; only sql {lacking}", took
    return True, f"{sum(got.values())} rows", took


if __name__ == "__main__":
    import __spark_entry__ as entry
    from cotejo import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        try:
            ok, message, took = check(spark, con, sf, name, fn, sqls.get(name))
        except Exception as e:
            ok, message, took = False, f"{type(e).__name__}: {str(e)[:1500]}", 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {took:.2f}s {message[:1800]}", flush=True)
    print("bad:", bad)
