"""Local correctness gate: run registered Spark queries and their DuckDB oracle.

    python tools/compare.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (floats rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from touchline.registry import REGISTRY  # noqa: E402
from touchline.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name in names:
        fn, sql = REGISTRY[name]
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK ERROR {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"{name:40s} rows={len(srows):8d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql)
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} DUCKDB ERROR {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        a, b = canon(scols, srows), canon(dcols, drows)
        ok_v = a == b
        status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        if status != "OK":
            bad += 1
        print(f"{name:40s} {status:8s} rows={len(srows)}/{len(drows)} cols={'ok' if ok_cols else 'DIFF'} vals={'ok' if ok_v else 'DIFF'} {ts:.1f}s")
        if not ok_cols:
            print("   spark-only:", sorted(set(scols) - set(dcols)), " duck-only:", sorted(set(dcols) - set(scols)))
        elif not ok_v:
            sa, sb = set(a), set(b)
            da = [r for r in a if r not in sb][:3]
            db = [r for r in b if r not in sa][:3]
            cs = sorted(scols)
            for x, y in zip(da, db):
                diffs = [(cs[i], x[i], y[i]) for i in range(len(cs)) if x[i] != y[i]]
                print("   diff:", diffs[:8])
            if not da and not db:
                print("   (multiset differs)")
    print(f"{bad} failing of {len(names)}")
    spark.stop()


if __name__ == "__main__":
    main()
