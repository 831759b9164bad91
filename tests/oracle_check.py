"""Compare a registered query with its DuckDB oracle, the way the driver does:
row count, column names, and an order-insensitive multiset of values.

Usable from tests and from the command line:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return ("f", round(v, 6))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["names_match"] = sorted(s_names) == sorted(d_names)
    if not out["names_match"]:
        out["spark_names"] = sorted(s_names)
        out["oracle_names"] = sorted(d_names)
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    out["values_match"] = a == b
    if a != b:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    out["ok"] = out["names_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


if __name__ == "__main__":
    from tillflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    import __spark_entry__ as entry

    names = sys.argv[2:] or list(entry.queries())
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on with the next query
            r = {"name": n, "error": repr(e)[:400]}
        bad += 0 if r.get("ok") or r.get("oracle") == "none" else 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
