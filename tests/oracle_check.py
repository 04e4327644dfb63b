"""Local stand-in for the driver's correctness gate.

Runs each registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names and an order-insensitive value
hash. Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def digest(rows) -> str:
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:400])
            print(f"{name:32s} SPARK_ERROR {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in oracles:
            results[name] = ("NO_ORACLE", len(srows))
            print(f"{name:32s} no-oracle rows={len(srows)} {ts:.1f}s")
            continue
        try:
            cur = con.execute(oracles[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK_ERROR", str(e)[:400])
            print(f"{name:32s} DUCK_ERROR {str(e)[:300]}")
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        a, b = frame_rows(scols, srows), frame_rows(ocols, orows)
        ok = ok_cols and len(a) == len(b) and digest(a) == digest(b)
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(orows))
        print(f"{name:32s} {'OK' if ok else 'MISMATCH'} rows={len(srows)}/{len(orows)} "
              f"cols_ok={ok_cols} {ts:.1f}s")
        if not ok and verbose:
            if not ok_cols:
                print("   spark:", sorted(scols))
                print("   duck :", sorted(ocols))
            else:
                sa, sb = set(a), set(b)
                for x in sorted(sa - sb)[:3]:
                    print("   spark-only:", x[:300])
                for x in sorted(sb - sa)[:3]:
                    print("   duck-only :", x[:300])
    return results


if __name__ == "__main__":
    from civora.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad={bad}")
