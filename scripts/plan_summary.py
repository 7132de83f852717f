"""Print a condensed physical plan per query: operators, exchanges, pushdown.

usage: python scripts/plan_summary.py [sf_dir] name...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import QUERIES  # noqa: E402
from eventide.session import get_spark  # noqa: E402


def summary(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for ln in plan.splitlines():
        m = re.match(r"^([\s:+\-*]*)(\w[\w ]*?)(\s|\(|\[|$)", ln)
        if not m:
            continue
        op = m.group(2).strip()
        extra = ""
        if op.startswith("FileScan") or "Scan parquet" in ln:
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", ln)
            extra = f" pushed=[{(pf.group(1) if pf else '')[:80]}] schema={(rs.group(1) if rs else '')[:100]}"
        if op.startswith("Exchange"):
            part = re.search(r"(hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|"
                             r"SinglePartition)", ln)
            extra = " " + (part.group(1) if part else "")
        lines.append(f"{m.group(1)}{op}{extra}")
    return "\n".join(lines)


if __name__ == "__main__":
    sf = sys.argv[1]
    spark = get_spark("local[8]", shuffle_partitions=16)
    for n in sys.argv[2:]:
        print(f"===== {n}")
        print(summary(QUERIES[n](spark, sf)))
