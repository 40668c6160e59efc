"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's check: columns sorted by name, row counts, and an
order-insensitive comparison of normalized values. Usable from pytest and
as a script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from freshet.sources.tables import TABLES, table_path  # noqa: E402


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    out = {
        "name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sc == dc, "values_match": sr == dr, "spark_sec": round(t1 - t0, 2),
    }
    if sc != dc:
        out["columns"] = (sc, dc)
    if sr != dr:
        only_s = list((sr - dr).elements())[:3]
        only_d = list((dr - sr).elements())[:3]
        out["diff"] = {"spark_only": only_s, "oracle_only": only_d}
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from freshet.session import build_session

    spark = build_session(shuffle_partitions=int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")), extra={"spark.ui.showConsoleProgress": "false"})
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": df.count()})
            continue
        res = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        bad += not res["ok"]
        print(res, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
