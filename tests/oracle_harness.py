"""Run a driver query on Spark and its SQL on DuckDB; compare as multisets.

Columns are compared by name (sorted), rows order-insensitively, values after a
light normalisation (Decimal -> float, dates/timestamps -> ISO text).  Used by
``tests/test_driver_oracle.py`` and runnable as a script for a full report:

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, int):
        return str(v)
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple("" if x is None else str(x) for x in t))
    return [cols[i].lower() for i in order], out


def compare(spark, key: str, sf_dir: str, con=None):
    from tierwise.plans.driver import QUERIES
    from tierwise.plans.oracle import ORACLE
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    res = con.execute(ORACLE[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = _canon(sdf.columns, srows)
    dcols2, d = _canon(dcols, drows)
    info = {"key": key, "spark_rows": len(s), "oracle_rows": len(d), "spark_s": round(t1 - t0, 2),
            "cols_ok": scols == dcols2, "rows_ok": len(s) == len(d), "values_ok": s == d}
    if not info["cols_ok"]:
        info["spark_cols"], info["oracle_cols"] = scols, dcols2
    elif not info["values_ok"]:
        ds = set(s) - set(d)
        dd = set(d) - set(s)
        info["only_spark"] = sorted(ds, key=str)[:3]
        info["only_oracle"] = sorted(dd, key=str)[:3]
    info["ok"] = info["cols_ok"] and info["rows_ok"] and info["values_ok"]
    return info


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tierwise.plans.driver import QUERIES
    from tierwise.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    keys = sys.argv[2:] or list(QUERIES)
    spark = get_session()
    con = duck(sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
