"""Compare every registered query with its DuckDB oracle on one scale factor.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match and value match (order-insensitive,
doubles rounded to 6 significant places).
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.6g}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (1, str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort()
    return [columns[i] for i in order], out


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main() -> int:
    from strata.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} SPARK ERROR {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sql:
            print(f"{name:34s} rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} DUCKDB ERROR {exc}")
            bad += 1
            continue
        sc, sr = canonical(s_cols, s_rows)
        dc, dr = canonical(d_cols, d_rows)
        ok = sc == dc and sr == dr
        bad += not ok
        detail = ""
        if sc != dc:
            detail = f" cols spark-only={sorted(set(sc) - set(dc))} duck-only={sorted(set(dc) - set(sc))}"
        elif sr != dr:
            ss, ds = set(sr), set(dr)
            detail = (f" spark-only={len(ss - ds)} duck-only={len(ds - ss)}"
                      f" e.g. S={sorted(ss - ds)[:1]} D={sorted(ds - ss)[:1]}")
        print(f"{name:34s} rows={len(s_rows)}/{len(d_rows)} {'OK' if ok else 'MISMATCH'}"
              f" {t1 - t0:.1f}s{detail}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
