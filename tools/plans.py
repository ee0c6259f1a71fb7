"""Write PLANS.md: the final adaptive physical plan of headline queries.

Each query runs once so the adaptive plan is final; the summary lists
exchanges, join strategies and aggregate kinds, followed by the plan (one
trimmed line per node).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans import queries as Q  # noqa: E402
from tidewater.session import build_session  # noqa: E402

NAMES = ["normalized_events", "exception_queue", "carrier_scorecard", "shipment_eta", "anchor_hours",
         "question_table"]
PATTERNS = {
    "shuffle exchanges": r"Exchange hashpartitioning|Exchange rangepartitioning",
    "single-partition exchanges": r"Exchange SinglePartition",
    "broadcast exchanges": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast hash joins": r"BroadcastHashJoin",
    "broadcast nested-loop joins": r"BroadcastNestedLoopJoin",
    "hash aggregates": r"\bHashAggregate",
    "sort aggregates": r"SortAggregate",
    "object hash aggregates": r"ObjectHashAggregate",
    "reused exchanges": r"ReusedExchange",
    "Python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    out = ["# PLANS", "", f"Final adaptive plans on `{sf_dir}` (local[8]); generated by `tools/plans.py`.", ""]
    for name in NAMES:
        df = Q.REGISTRY[name](spark, sf_dir)
        df.collect()  # small at this scale; makes the adaptive plan final
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        counts = {k: len(re.findall(p, final)) for k, p in PATTERNS.items()}
        lines = [ln[:150] + (" ..." if len(ln) > 150 else "") for ln in final.splitlines()
                 if ln.strip() and "== Final Plan ==" not in ln]
        out += [f"## {name}", "", ", ".join(f"{k}: {v}" for k, v in counts.items() if v), "",
                "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
