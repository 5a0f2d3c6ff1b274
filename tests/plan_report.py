"""Write PLANS.md: the physical plan shape of every registered query with
auto-broadcast disabled (what a large cluster gets; only size-checked hints
broadcast).  Usage: python tests/plan_report.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    return {
        "scans": plan.count("FileScan"),
        "reused": plan.count("ReusedExchange"),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "hash_agg": plan.count("HashAggregate("),
        "sort_agg": plan.count("SortAggregate("),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "generate": plan.count("Generate "),
        "nested_loop": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
    }


def main(argv):
    from credlake.plans import ORACLES, QUERIES
    from credlake.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    for name in QUERIES:
        if name.startswith("ml_") or name.startswith("stream_"):
            continue
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        rows.append((name, s, name in ORACLES))
    out = ["# Plan shapes", "",
           "Physical plans of the registered queries with `spark.sql.autoBroadcastJoinThreshold=-1` (the shape on a",
           "large cluster: only the size-checked broadcast hints remain). Generated by `tests/plan_report.py`;",
           "streaming and model queries are left out (they execute while planning). AQE may still turn joins",
           "into broadcasts or split skewed partitions at run time.", "",
           "| query | scans | exchanges | reused exchanges | broadcast (hinted) | sort-merge joins | hash aggs | sort aggs | windows | generate | nested-loop/cartesian |",
           "|---|---|---|---|---|---|---|---|---|---|---|"]
    for name, s, _ in rows:
        out.append(f"| `{name}` | {s['scans']} | {s['exchanges']} | {s['reused']} | {s['broadcasts']} | {s['smj']} | {s['hash_agg']} | "
                   f"{s['sort_agg']} | {s['windows']} | {s['generate']} | {s['nested_loop']} |")
    for name in ("lsh_top_risk_buckets", "flow_p0_flat"):
        df = QUERIES[name](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        text = re.sub(r"file:[^\]\s,]*/", "", text)  # no local paths
        out += ["", f"## `{name}` (explain formatted, auto-broadcast off)", "", "```", text.strip(), "```"]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main(sys.argv)
