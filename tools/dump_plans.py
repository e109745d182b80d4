"""Write docs/PLANS.md: the physical plans (AQE off, so the static plan is
shown) of the catalog's key queries at sf0.1, reduced to operators, pushed
filters and read schemas.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = ["calendar_status", "first_row_per_key", "slots_topn", "multi_flags", "touch_union_agg",
       "touch_consolidate", "substring_lookup", "arrears_days", "consolidate_left", "contact_slots",
       "assignment_table", "monthly_consolidation"]


def simplify(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        m = re.match(r"^([\s:+\-|*()0-9]*)(\w[\w ]*?)(?: \[|\(| |$)(.*)$", line)
        if not m:
            continue
        indent, op, rest = m.groups()
        extra = ""
        if op.startswith("FileScan"):
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", rest)
            rs = re.search(r"ReadSchema: (\S+)", rest)
            extra = f" PushedFilters={pf.group(1) if pf else '[]'} ReadSchema={rs.group(1) if rs else ''}"
        elif op.startswith("Exchange"):
            extra = " " + rest.split(",")[0][:60]
        elif op in ("BroadcastHashJoin", "SortMergeJoin"):
            jt = re.search(r"(Inner|LeftOuter|FullOuter|LeftSemi|LeftAnti)", rest)
            extra = f" {jt.group(1) if jt else ''}"
        out.append(f"{indent}{op}{extra}")
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from recaudo.session import get_session
    from recaudo.plans.catalog import QUERIES
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.sql.adaptive.enabled": "false"})
    parts = ["# Physical plans of key catalog queries\n",
             f"Generated by `python tools/dump_plans.py` on `{sf}` with AQE off (static plan; at run time "
             "AQE may turn shuffle joins of small sides into broadcasts and split skewed partitions). "
             "`*` marks whole-stage code generation.\n"]
    for name in KEY:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        parts.append(f"## {name}\n\n```\n{simplify(plan)}\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(parts))
    print(path)


if __name__ == "__main__":
    main()
