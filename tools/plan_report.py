"""Write PLANS.md: the physical shape of each headline query.

Two plans per query: as run here (AQE on, broadcast thresholds at their
defaults, so small sides become broadcasts) and the at-scale shape (automatic
broadcasts off, as when the data is far larger than the thresholds).

usage: python tools/plan_report.py [--sf DIR] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from pressroom.plans.registry import load_all  # noqa: E402
from pressroom.session import local_session  # noqa: E402

PATTERNS = {
    "hash exch": r"Exchange hashpartitioning",
    "range exch": r"Exchange rangepartitioning",
    "single exch": r"Exchange SinglePartition",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "BNLJ/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow \[",
    "python": r"MapInPandas|ArrowEvalPython",
    "subquery": r"Subquery subquery",
}


def summarize(plan: str) -> dict:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    args = ap.parse_args()
    spark = local_session(8, 16)
    reg = load_all()
    rows = []
    for mode in ("as run", "at scale"):
        if mode == "at scale":
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        for name in HEADLINE:
            df = reg[name].build(spark, args.sf)
            df.write.format("noop").mode("overwrite").save()
            plan = df._jdf.queryExecution().executedPlan().toString()
            pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
            rows.append((mode, name, summarize(plan), pushed))
    with open(args.out, "w") as f:
        f.write("# Physical plans of the headline queries\n\n")
        f.write(f"Generated by `tools/plan_report.py` on `{args.sf}` (Spark {spark.version}, AQE on). "
                "Counts are operators in the final adaptive plan of the query (the steps a "
                "query runs while it is built, such as staging writes, are separate jobs and not shown). *At scale* turns automatic broadcasts "
                "off, which is how the plans look when the inputs are far larger than the thresholds.\n\n")
        cols = list(PATTERNS)
        for mode in ("as run", "at scale"):
            f.write(f"## {mode}\n\n| query | " + " | ".join(cols) + " | pushed filters |\n")
            f.write("|---|" + "---|" * len(cols) + "---|\n")
            for m, name, s, pushed in rows:
                if m == mode:
                    pf = "; ".join(p[:80] for p in pushed[:2])
                    f.write(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + f" | {pf} |\n")
            f.write("\n")
    print("wrote", args.out)


if __name__ == "__main__":
    main()
