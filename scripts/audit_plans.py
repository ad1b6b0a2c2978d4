"""Print one markdown row per registered key: jobs run while it is built, exchanges, physical operators.

usage: python scripts/audit_plans.py [sf_dir]   (auto-broadcast off, as on cluster-sized tables)
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from mercato.plans.registry import all_queries  # noqa: E402
from mercato.session import build_session  # noqa: E402

FLAGS = ["SinglePartition", "SortAggregate", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Expand", "WindowGroupLimit"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    sc = spark.sparkContext
    for key, fn in sorted(all_queries().items()):
        # the physical plan before execution (after it, the adaptive plan prints
        # both its final and its initial form)
        sc.setJobGroup(key, key)
        df = fn(spark, sf_dir)
        jobs = len(sc.statusTracker().getJobIdsForGroup(key))
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))
        windows = len(re.findall(r"\bWindow \[", plan))
        hits = [f"{f}×{plan.count(f)}" for f in FLAGS if plan.count(f)]
        if windows:
            hits.append(f"Window×{windows}")
        print(f"| {key} | {jobs} | {exchanges} | {', '.join(hits)} |", flush=True)


if __name__ == "__main__":
    main()
