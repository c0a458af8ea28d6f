"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables and compare row count, column names and the multiset of rows.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    from shelfwise.plans.bindings import TABLES
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if approx else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_key(rows, cols, approx):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="no-oracle", rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.sql(sql)
    dcols = res.columns
    drows = res.fetchall()
    st = dict(name=name, spark_rows=len(srows), duck_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        st.update(status="COLUMNS", spark_cols=scols, duck_cols=dcols)
        return st
    if len(srows) != len(drows):
        st["status"] = "ROWCOUNT"
        return st
    a, b = rows_key(srows, scols, False), rows_key(drows, dcols, False)
    if a == b:
        st["status"] = "ok"
        return st
    a2, b2 = rows_key(srows, scols, True), rows_key(drows, dcols, True)
    st["status"] = "approx" if a2 == b2 else "VALUES"
    if st["status"] == "VALUES":
        diff = [(x, y) for x, y in zip(a2, b2) if x != y][:3]
        st["diff"] = diff
        st["cols"] = sorted(scols)
    return st


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from shelfwise.session import build_session
    if os.environ.get("PLAIN_SESSION"):
        # a session with Spark's defaults only, as a driver may create it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n, fn in qs.items():
        if names and n not in names:
            continue
        try:
            st = compare(spark, con, n, fn, sqls.get(n), sf_dir)
        except Exception as e:  # report and continue
            st = dict(name=n, status="ERROR", error=str(e)[:800])
        if st["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(st, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
