"""Run registered jobs from the command line (spark-submit friendly).

    spark-submit -m triage.cli list
    spark-submit -m triage.cli run rules_accepted --sf /data/sf1 --out /shared/out/rules_accepted
    python -m triage.cli show cat_distribution --sf /root/testdata/sf0.01 -n 20
    python -m triage.cli sql gateway_decisions          # print the DuckDB oracle

``run`` writes Parquet to a fresh path (never over its own input); without ``--out`` it runs
the query to completion through the ``noop`` sink and reports the time.
"""

from __future__ import annotations

import argparse
import sys
import time


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="triage")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "show", "sql", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--sf", default="/root/testdata/sf0.01")
        if name == "run":
            p.add_argument("--out")
        if name == "show":
            p.add_argument("-n", type=int, default=20)
    a = ap.parse_args(argv)

    from triage.registry import load_all
    reg = load_all()
    if a.cmd == "list":
        for n, q in sorted(reg.items()):
            print(f"{n:32s} {'oracle' if q.sql else 'rows-only':9s} {q.ops}")
        return 0
    if a.query not in reg:
        print(f"unknown query {a.query}", file=sys.stderr)
        return 2
    q = reg[a.query]
    if a.cmd == "sql":
        print(q.sql or "-- no SQL twin (rows-only check)")
        return 0

    from triage.session import get_spark
    spark = get_spark()
    df = q.run(spark, a.sf)
    if a.cmd == "explain":
        df.explain("formatted")
    elif a.cmd == "show":
        df.show(a.n, truncate=80)
    else:
        t0 = time.perf_counter()
        if a.out:
            df.write.mode("errorifexists").parquet(a.out)
        else:
            df.write.format("noop").mode("overwrite").save()
        print(f"{a.query}: {time.perf_counter() - t0:.2f}s" + (f" -> {a.out}" if a.out else ""))
    return 0


if __name__ == "__main__":
    sys.exit(main())
