"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed (every row produced, written to
Spark's no-op sink so nothing is pulled through the driver); the time covers
both. Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "reconcile",               # guarded full outer join, every row classified
    "status_summary",          # four-row in-scope summary
    "entity_status",           # per-precinct verification
    "kpi_summary",             # three denominators
    "reporting_by_entity",     # universe left join + aggregates
    "timeline",                # first receipt per precinct, running coverage
    "safe_singles",            # distinct-count guarded totals
    "results_snapshot",        # cleaning under contract (text -> typed)
    "ballot_map",              # name matching + union
    "check_result_duplicates",
    "check_repeated_contest_totals",
    "check_result_value_invalid",
    "quality_summary",         # all 20 checks counted in one job
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from tallycheck.plans import catalog, fixtures
    from tallycheck.session import get_session

    spark = get_session()
    # warm the JVM (class loading, first code generation) outside the timings
    catalog.QUERIES["flag_parse"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        # no plan or data of an earlier query is left
        fixtures.clear_views()
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
