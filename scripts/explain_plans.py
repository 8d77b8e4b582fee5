"""Write PLANS.md: the physical plan of selected registered queries with a short plan summary.

Usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.queries import registry  # noqa: E402
from riskloom.session import get_spark  # noqa: E402

SELECTED = ["triage_report", "scan_scorecard", "bulk_rule_scores", "recipe_diabetes", "null_profile",
            "corr_matrix", "group_median_fill", "stratified_split", "best_per_group", "kde", "dedupe",
            "features_targets_join", "rule_attribution"]


SHUFFLE = re.compile(r"(?<![A-Za-z])Exchange \(\d+\)")
BROADCAST = re.compile(r"BroadcastExchange \(\d+\)")
CODEGEN = re.compile(r"codegen id : (\d+)")
READ = re.compile(r"ReadSchema: (struct<[^>]*>)")
PUSHED = re.compile(r"PushedFilters: \[([^\]]*)\]")


def summary(tree: str, plan: str) -> str:
    scans = READ.findall(plan)
    pushed = [p for p in PUSHED.findall(plan) if p]
    return (f"- shuffle exchanges: {len(SHUFFLE.findall(tree))}; broadcast exchanges: {len(BROADCAST.findall(tree))}; "
            f"whole-stage codegen stages: {len(set(CODEGEN.findall(plan)))}\n"
            f"- scans read: {'; '.join(scans)}\n- pushed filters: {'; '.join(pushed) or 'none'}\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    reg = registry()
    out = ["# Physical plans of selected queries\n",
           f"Generated by `scripts/explain_plans.py {sf}` (`explain('formatted')`, final adaptive plans "
           "after execution). Statistics that an operator computes eagerly (fitted values, checkpointed rank "
           "inputs) appear as scans of their results.\n"]
    for name in SELECTED:
        df = reg[name][0](spark, sf)
        df.collect()  # run it, so the adaptive plan shown is the final one
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        head = plan.split("\n\n(1)")[0]
        if "== Initial Plan ==" in head:  # keep only the final adaptive plan
            head = head.split("== Initial Plan ==")[0].rstrip().rstrip("+-").rstrip()
        out.append(f"## {name}\n\n{summary(head, plan)}\n```\n{head.strip()}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
