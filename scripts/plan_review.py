"""Summarise the physical plan of every registered query.

usage: python scripts/plan_review.py [sf_dir] > PLANS.md

For each query: number of shuffles (Exchange), broadcast / sort-merge joins,
whether the fact scan is partition-pruned, whether any Python evaluation
(UDF / pandas) or cartesian product appears.  Plans are the initial
adaptive plans (before run-time re-optimisation).
"""

import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from roadflow.registry import queries  # noqa: E402
from roadflow.session import local_session  # noqa: E402

SKIP = {"etl_incremental_load", "stream_pages_ingest", "export_reports", "dq_report", "dq_status_totals",
        "profile_files"}  # these run jobs while building their result (plans are of a local relation)


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "python": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") + plan.count("FlatMapGroupsInPandas"),
        "pruned_fact": re.search(r"PartitionFilters: \[[^\]]*DateKey#\d+ (=|>=|IN|<=)", plan) is not None
        or re.search(r"PartitionFilters: \[[^\]]*DateKey#\d+ IN", plan) is not None,
        "window": plan.count("Window "),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("| query | shuffles | broadcast joins | sort-merge joins | cartesian | python | year-pruned fact | windows |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in queries().items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        print(f"| {name} | {s['exchanges']} | {s['bhj']} | {s['smj']} | {s['cartesian']} | {s['python']} | "
              f"{'yes' if s['pruned_fact'] else ''} | {s['window']} |")


if __name__ == "__main__":
    main()
