"""Run registered queries on Spark and their SQL oracles on DuckDB; compare rows, columns, values.

usage: python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name-prefix ...]
"""
from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fieldops.catalog import load_all  # noqa: E402
from fieldops.session import build_session  # noqa: E402
from fieldops.sources.tables import TABLES  # noqa: E402


STRICT = False


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v) if STRICT else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if STRICT else f"{float(v):.6g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6g}" if abs(v) > 2**53 else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("--strict", action="store_true", help="compare floats/decimals exactly (repr)")
    ap.add_argument("--plain", action="store_true", help="use a default session (as the driver does)")
    ap.add_argument("prefix", nargs="*")
    a = ap.parse_args()
    global STRICT
    STRICT = a.strict
    if a.plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for tname in TABLES:
        con.execute(f"create view {tname} as select * from read_parquet('{a.sf}/{tname}.parquet')")
    reg = load_all()
    names = [n for n in reg if not a.prefix or any(n.startswith(p) for p in a.prefix)]
    ok = bad = norac = 0
    for n in names:
        e = reg[n]
        t0 = time.time()
        try:
            sdf = e.fn(spark, a.sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as ex:  # noqa: BLE001
            print(f"SPARK-ERR {n}: {str(ex)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not e.sql:
            print(f"rows-only {n}: {len(srows)} rows {ts:.1f}s")
            norac += 1
            continue
        try:
            cur = con.execute(e.sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"DUCK-ERR {n}: {str(ex)[:600]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"COLS {n}: spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        if len(srows) != len(drows) or hs != hd:
            print(f"MISMATCH {n}: rows spark={len(srows)} duck={len(drows)}")
            if a.show:
                s1, s2 = set(ls), set(ld)
                print("  cols:", sorted(scols))
                for x in sorted(s1 - s2)[:5]:
                    print("  spark-only:", x)
                for x in sorted(s2 - s1)[:5]:
                    print("  duck-only :", x)
            bad += 1
            continue
        ok += 1
        print(f"OK {n}: {len(srows)} rows {ts:.1f}s")
    print(f"== ok={ok} bad={bad} rows-only={norac} of {len(names)}")


if __name__ == "__main__":
    main()
