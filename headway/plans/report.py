"""Physical-plan summary of every registered query (for plan review).

    python -m headway.plans.report /root/testdata/sf0.01 > PLANS.md

Counts, per query, the shuffles, join strategies, aggregate operators,
window operators and scans with pushed filters of the executed plan.
"""

from __future__ import annotations

import re
import sys

SKIP = {"cascade_flags_stream", "route_speed_stream", "model_metrics"}  # run jobs while being built

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
                r"Exchange RoundRobinPartitioning",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "shuffled hash joins": r"ShuffledHashJoin",
    "partial aggs": r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_",
    "object aggs": r"ObjectHashAggregate",
    "windows": r"\bWindow \[",
    "generators": r"\bGenerate ",
    "scans w/ pushed filters": r"PushedFilters: \[(?!\])",
}


def summarize(plan: str) -> dict[str, int]:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main(sf_dir: str) -> None:
    from headway.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    from headway.plans import registry

    cols = list(PATTERNS)
    print("# Physical plan summary\n")
    print(f"Executed plans at `{sf_dir}` (AQE final plans after one run). Generated by "
          "`python -m headway.plans.report`. No query has a Cartesian product, a "
          "nested-loop join or a Python evaluation node (tests/test_plans.py).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in registry.QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
