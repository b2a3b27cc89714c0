"""Summarise the physical plan of every query of the transfer library as a markdown table.

Usage: python tools/plan_notes.py [sf_dir] > docs/PLANS.md

Per key: shuffle exchanges by kind, join strategies, whether filters reach the
parquet scan, and whether any cartesian / nested-loop join appears. Keys that
land files build their DataFrame by writing first (so they run here).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ferry.demos import QUERIES  # noqa: E402
from ferry.session import local_session  # noqa: E402


def summary(plan: str) -> dict:
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    return {
        "hash": ex.count("hashpartitioning"),
        "range": ex.count("rangepartitioning"),
        "single": ex.count("SinglePartition"),
        "broadcast": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted({j for j in re.findall(
            r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)})),
        "pushed": "yes" if re.search(r"PushedFilters: \[[A-Za-z]", plan) else "-",
        "python": "yes" if re.search(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)", plan)
        else "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, initial adaptive plan)\n")
    print("Counts are exchanges in the plan before AQE re-planning; a shuffle exchange listed twice under one "
          "reused subtree runs once (`ReusedExchange` at run time). At this scale Catalyst broadcasts every "
          "dimension below `spark.sql.autoBroadcastJoinThreshold` (a size check on statistics); at 100 TB the "
          "same plans switch to sort-merge joins with AQE skew splitting. `single` = a SinglePartition "
          "exchange: it only carries the partial results of a global aggregate (one row per task) or the "
          "per-partition count table of the numbering operators (at most one row per partition), never table "
          "rows. `python` = any Python UDF / pandas stage (there is none).\n")
    print("| key | hash | range | single | broadcast | joins | pushed filters | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for key, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{key}` | {s['hash']} | {s['range']} | {s['single']} | {s['broadcast']} | {s['joins'] or '-'} | "
              f"{s['pushed']} | {s['python']} |")


if __name__ == "__main__":
    main()
