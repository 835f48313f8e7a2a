"""Write PLANS.md: the physical shape of every registered query.

For each query the final adaptive plan is inspected after execution (sf dir
given on the command line, default sf0.01): parquet scans and the columns
they read, exchanges (hash / range / single), windows, joins by strategy,
aggregates, and whether any Python runs in the plan.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def shape(plan: str) -> dict:
    lines = plan.splitlines()
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    return {
        "scans": count(r"FileScan parquet|Scan parquet"),
        "hash_exch": count(r"Exchange hashpartitioning"),
        "single_exch": count(r"Exchange SinglePartition"),
        "range_exch": count(r"Exchange rangepartitioning"),
        "bhj": count(r"BroadcastHashJoin"),
        "smj": count(r"SortMergeJoin"),
        "windows": count(r"\bWindow \["),
        "group_limit": count(r"WindowGroupLimit"),
        "aggs": count(r"HashAggregate|SortAggregate|ObjectHashAggregate"),
        "python": count(r"PythonUDF|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas"),
        "nested_loop": count(r"BroadcastNestedLoopJoin|CartesianProduct"),
    }


def main(argv):
    from lapdeck.plans.registry import load_all
    from lapdeck.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    cols = ["scans", "hash_exch", "single_exch", "range_exch", "bhj", "smj", "windows",
            "group_limit", "aggs", "python", "nested_loop"]
    out = ["# PLANS", "",
           f"Physical plan shape of every registered query (`{sf_dir}`, local[8]; generated by",
           "`tools/plan_report.py`), as initial / final adaptive plan where they differ.  Jobs that a query runs",
           "before its last plan (written tables) are not counted.  `hash_exch` counts hash",
           "shuffles -- most carry partial aggregates, not rows (see README, Design for",
           "scale); `bhj` are joins AQE or a size check turned into broadcasts;",
           "`group_limit` = map-side WindowGroupLimit; `python` = Python in the plan.", "",
           "| query | ops | " + " | ".join(cols) + " |",
           "|---|---|" + "---|" * len(cols)]
    for name, q in load_all().items():
        df = q.build(spark, sf_dir)
        df.collect()  # execute this very Dataset so its adaptive plan is final
        plan = df._jdf.queryExecution().executedPlan().toString()
        # an executed adaptive plan prints the final plan and then the initial one
        final, _, first = plan.partition("== Initial Plan ==")
        a, b = shape(first or final), shape(final)
        out.append(f"| {name} | {q.ops} | " + " | ".join(str(b[c]) if a[c] == b[c] else f"{a[c]} / {b[c]}" for c in cols) + " |")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1:])
