"""Side-by-side check of every registered query against its DuckDB SQL (what the driver does):
row count, column names, and an order-insensitive comparison of the values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as err:  # noqa: BLE001
            report[k] = {"ok": False, "error": f"spark: {err}"[:800]}
            if verbose:
                print(k, "SPARK ERROR", str(err)[:800], flush=True)
            continue
        t_spark = time.time() - t0
        if k not in sql:
            report[k] = {"ok": None, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
            if verbose:
                print(f"{k:34s} rows-only {len(s_rows):8d} {t_spark:6.2f}s", flush=True)
            continue
        try:
            res = con.execute(sql[k])
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as err:  # noqa: BLE001
            report[k] = {"ok": False, "error": f"duckdb: {err}"[:800]}
            if verbose:
                print(k, "DUCKDB ERROR", str(err)[:800], flush=True)
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        same_rows = same_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
        ok = same_cols and len(s_rows) == len(d_rows) and same_rows
        report[k] = {"ok": ok, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t_spark, 2)}
        if verbose:
            print(f"{k:34s} {'OK ' if ok else 'BAD'} spark={len(s_rows):8d} duck={len(d_rows):8d} {t_spark:6.2f}s",
                  flush=True)
            if not same_cols:
                print("   cols spark-only", sorted(set(s_cols) - set(d_cols)), "duck-only", sorted(set(d_cols) - set(s_cols)))
            elif not same_rows:
                a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                sa, sb = set(a), set(b)
                print("   cols", sorted(s_cols))
                print("   spark-only e.g.", list(sa - sb)[:3])
                print("   duck-only  e.g.", list(sb - sa)[:3])
    return report


if __name__ == "__main__":
    from draftledger.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = build_session("local[8]")
    rep = compare(spark, sf, keys)
    bad = [k for k, v in rep.items() if v["ok"] is False]
    print("BAD:", bad)
