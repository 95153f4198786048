"""Write PLANS.md: the physical-plan shape of every registered query.

python tests/plan_report.py [data_dir]   (default /root/testdata/sf0.1)

Counts come from the executed plan before adaptive re-planning (AQE may
still demote a shuffle join to a broadcast join at run time).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from verdant.plans import QUERIES  # noqa: E402
from verdant.session import build_session  # noqa: E402


def shape(plan: str) -> dict:
    return {
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range/round-robin": len(re.findall(r"Exchange (rangepartitioning|RoundRobinPartitioning)", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial top-k": plan.count("WindowGroupLimit") // 2,
        "partial aggs": len(re.findall(r"functions=\[partial_", plan)),
        "pushed filters": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
    }


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    rows = []
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, data_dir)
        rows.append((name, shape(df._jdf.queryExecution().executedPlan().toString())))
    cols = list(rows[0][1])
    out = ["# Plan shapes", "",
           f"Generated by `tests/plan_report.py` at `{data_dir}` (local[8], 32 MiB broadcast bound).",
           "Counts are from the executed plan before adaptive re-planning.", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, s in rows:
        out.append(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    path = os.path.join(ROOT, "PLANS.md")
    head = open(path).read().split("# Plan shapes")[0] if os.path.exists(path) else ""
    with open(path, "w") as f:
        f.write(head + "\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
