"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values
(doubles rounded to 6 digits).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return sorted(cols), len(rows), h, lines


def compare(spark, con, name, fn, sql, sf_dir, show=5):
    t = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    ts = time.time() - t
    scols = df.columns
    t = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    td = time.time() - t
    a, b = digest(scols, srows), digest(dcols, drows)
    ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
    print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={a[1]} ({ts:.1f}s) duck={b[1]} ({td:.1f}s) cols_equal={a[0] == b[0]}")
    if not ok:
        if a[0] != b[0]:
            print("  spark cols", a[0], "\n  duck cols ", b[0])
        sa, sb = set(a[3]), set(b[3])
        for x in sorted(sa - sb)[:show]:
            print("  only spark:", x[:300])
        for x in sorted(sb - sa)[:show]:
            print("  only duck: ", x[:300])
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        from colloquy.session import build_session
        spark = build_session()
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = []
    for name in names or list(qs):
        if name not in os_:
            t = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} ROWS-ONLY spark={n} ({time.time() - t:.1f}s)")
            continue
        try:
            if not compare(spark, con, name, qs[name], os_[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:800]}")
            bad.append(name)
    print("BAD:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
