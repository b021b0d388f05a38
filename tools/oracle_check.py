"""Run registry queries in Spark and their oracle SQL in DuckDB; compare like the driver.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
Compares column names (sorted), row count and an order-insensitive hash of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from triage.registry import load_all  # noqa: E402
from triage.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted("|".join(norm(r[i]) for i in order) for r in rows)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for name, q in sorted(reg.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = q.run(spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"rows-only  {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(q.sql)
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {name}: {str(e)[:600]}")
            bad += 1
            continue
        sc, sv = canon(scols, srows)
        dc, dv = canon(dcols, drows)
        ok = sc == dc and sv == dv
        if not ok:
            bad += 1
            print(f"MISMATCH   {name}: spark {len(sv)} rows {sc}\n           duck  {len(dv)} rows {dc}")
            ds = sorted(set(sv) - set(dv))[:3]
            dd = sorted(set(dv) - set(sv))[:3]
            print("   spark-only:", ds, "\n   duck-only: ", dd)
        else:
            print(f"ok         {name}: {len(sv)} rows ({ts:.1f}s)")
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
