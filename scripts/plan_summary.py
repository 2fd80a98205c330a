"""Summarise the physical plan of every registered query (what .explain() shows).

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts, per query, the operators that decide cost at scale: exchanges (shuffles), broadcast
and sort-merge joins, nested-loop joins, top-k, window group limits, scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chanwh import catalog  # noqa: E402
from chanwh.session import get_spark  # noqa: E402

PATTERNS = {
    "hash shuffle": r"Exchange hashpartitioning",
    "range shuffle": r"Exchange rangepartitioning",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "to one partition": r"Exchange SinglePartition",
    "broadcast": r"Exchange (HashedRelation|Identity)BroadcastMode",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "BNLJ": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "top-k": r"TakeOrderedAndProject",
    "window limit": r"WindowGroupLimit",
    "window": r"\bWindow\b",
    "scan parquet": r"FileScan parquet",
    "scan checkpoint": r"Scan ExistingRDD",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")
    cols = list(PATTERNS)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_summary.py` at `{sf_dir}` (counts of operators in `.explain()`,")
    print("subquery plans included). Every input is a Parquet scan; nothing is checkpointed.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in catalog.QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        plan = buf.getvalue()
        c = Counter({k: len(re.findall(p, plan)) for k, p in PATTERNS.items()})
        print(f"| `{name}` | " + " | ".join(str(c[k]) if c[k] else "" for k in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
