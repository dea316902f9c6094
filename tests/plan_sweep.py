"""Scan the executed plans of every registered query for operators that do not
survive scale: cartesian products, nested-loop joins, Python evaluation, and
single-partition exchanges other than a global aggregate's final merge or the
numbering offsets (one row per partition).

Usage: python -m tests.plan_sweep [sf_dir] [name ...]
"""

from __future__ import annotations

import re
import sys

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def findings(df) -> list[str]:
    df.collect()  # runs this DataFrame's own plan, so that what is read below is the final one
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    out = [b for b in BAD if b in plan]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = re.sub(r"#\d+L?", "", lines[i + 1].strip()) if i + 1 < len(lines) else ""
            if "partial_" not in below and "_pid" not in below:
                out.append("SinglePartition over " + below[:120])
    return out


def main(argv) -> None:
    sys.path.insert(0, ".")
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from strata.catalog import load_all
    from strata.session import build_session
    spark = build_session("plan-sweep")
    flagged = 0
    for name, q in load_all().items():
        if argv[1:] and name not in argv[1:]:
            continue
        found = findings(q.build(spark, sf_dir))
        if found:
            flagged += 1
            print(name, found, flush=True)
    print("flagged", flagged)


if __name__ == "__main__":
    main(sys.argv[1:])
