"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (full execution, nothing collected).
untimed (planning, code generation, JIT) and is then timed on its second run; the first-run
times are reported too, under ``cold``. ``BENCH_QUERIES`` (comma list) narrows the set;
``BENCH_ALL=1`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rule_mining", "rules_accepted", "rules_payload", "gateway_decisions", "match_coverage", "clean_plain",
    "clean_html", "content_duplicates", "cat_distribution", "domains_by_category", "category_overview",
    "state_diff", "sender_learning", "decision_upsert", "constraint_violations", "notifications",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from triage.registry import load_all
    from triage.session import get_spark

    spark = get_spark(cpus=cpus, shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    names = os.environ.get("BENCH_QUERIES")
    if os.environ.get("BENCH_ALL") == "1":
        todo = sorted(reg)
    elif names:
        todo = [n for n in names.split(",") if n in reg]
    else:
        todo = [n for n in HEADLINE if n in reg]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    cold = {name: run(name) for name in todo}
    times = {name: run(name) for name in todo}
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in os.path.basename(sf_dir) else sf_dir
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "cold_total": round(sum(cold.values()), 3), "cold": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
