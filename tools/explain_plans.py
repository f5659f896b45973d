"""Summarise the physical plans of the headline queries.

    python tools/explain_plans.py [sf_dir] > docs/PLANS.md

For every query: number of shuffles (Exchange), broadcasts, join strategies,
windows, Expand nodes, and for every parquet scan the columns read and the
filters pushed into it. Plans are taken before execution (AQE may still turn a
sort-merge join into a broadcast at runtime when a shuffled side is small).
"""

from __future__ import annotations

import io
import os
import re
import sys
from collections import Counter
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["reconcile", "status_summary", "entity_status", "kpi_summary", "reporting_by_entity",
           "reporting_with_district", "timeline", "safe_singles", "results_snapshot", "map_positions",
           "ballot_map", "check_result_duplicates", "check_missing_result_precincts",
           "check_result_party_unmatched", "check_repeated_contest_totals", "check_result_value_invalid",
           "check_required_value_blanks", "check_qr_orphan_er", "check_scope_readiness", "quality_summary"]
NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Expand", "Generate", "HashAggregate",
         "Scan parquet"]


def summarise(plan: str) -> tuple[Counter, list[str]]:
    tree = plan.split("\n\n(1)")[0]
    counts = Counter()
    for line in tree.splitlines():
        m = re.search(r"(?:[+:]-\s*|^)([A-Z][A-Za-z ]*?)\s*\(\d+\)\s*$", line.strip())
        if not m:
            continue
        name = m.group(1).strip()
        for n in NODES:
            if name == n or name.startswith(n + " "):
                counts[n] += 1
                break
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\) |\Z)", plan, flags=re.S):
        loc = re.search(r"Location: \S+ \[file:[^\]]*/([^/\]]+)\]", block)
        pushed = re.search(r"PushedFilters: (\[.*?\])", block)
        schema = re.search(r"ReadSchema: struct<(.*)>", block)
        cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema else []
        scans.append(f"{loc.group(1) if loc else '?'}: reads {cols}"
                     + (f", pushed {pushed.group(1)}" if pushed else ""))
    return counts, scans


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tallycheck.plans import catalog
    from tallycheck.session import get_session

    spark = get_session()
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/explain_plans.py` on `{d}` (plans before execution).\n")
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, d)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        counts, scans = summarise(buf.getvalue())
        shown = ", ".join(f"{k} {v}" for k, v in counts.items() if k != "Scan parquet") or "none"
        print(f"## {name}\n")
        print(f"- operators: {shown}")
        for s in scans:
            print(f"- scan {s}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
