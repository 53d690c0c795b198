"""Summarise the physical plan of registered queries: exchanges, join
strategies, top-k / sort operators and what each Parquet scan reads.

usage: python scripts/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.plans.catalog import QUERIES  # noqa: E402
from meterlake.session import get_session  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin",
       "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "TakeOrderedAndProject", "Window", "Expand", "Subquery", "InMemoryTableScan"]


def summarise(plan: str) -> str:
    counts = {op: plan.count(op) for op in OPS if plan.count(op)}
    scans = []
    for m in re.finditer(r"FileScan parquet \[[^\]]*\].*?PushedFilters: (\[[^\]]*\]).*?ReadSchema: (struct<[^>]*>)", plan):
        scans.append(f"    scan pushed={m.group(1)} read={m.group(2)}")
    ops = ", ".join(f"{k} x{v}" for k, v in counts.items())
    return ops + ("\n" + "\n".join(sorted(set(scans))) if scans else "")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    for n in names:
        try:
            plan = QUERIES[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"{n}: ERROR {e}")
            continue
        print(f"{n}: {summarise(plan)}")
    spark.stop()


if __name__ == "__main__":
    main()
