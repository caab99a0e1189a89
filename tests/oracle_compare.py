"""Run each registered query in Spark and its oracle SQL in DuckDB; compare like the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as E  # noqa: E402
from stagegate.sources.seeded import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, sf_dir, name):
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return name, "no-oracle", len(s_rows), None, t1 - t0
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok = ok_cols and canon(s_cols, s_rows) == canon(d_cols, d_rows)
    info = "" if ok else f" spark_cols={s_cols} duck_cols={d_cols}"
    if ok_cols and not ok:
        a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        info += f" only_spark={diff_a} only_duck={diff_b}"
    return name, ("OK" if ok else "MISMATCH" + info), len(s_rows), len(d_rows), t1 - t0


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    from stagegate.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n)
        except Exception as exc:  # report and go on
            r = (n, f"ERROR {type(exc).__name__}: {str(exc)[:300]}", None, None, 0)
        bad += not str(r[1]).startswith("OK")
        print(f"{r[0]:28s} {r[1]} spark_rows={r[2]} duck_rows={r[3]} {r[4]:.2f}s", flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
