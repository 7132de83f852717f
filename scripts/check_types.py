"""Compare Spark result types with the DuckDB twin's result types for every query."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import ORACLE, QUERIES  # noqa: E402
from eventide.plans.compare import duck, type_diffs  # noqa: E402
from eventide.session import get_spark  # noqa: E402

def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    names = argv[2:] or sorted(ORACLE)
    spark = get_spark("local[4]", shuffle_partitions=4)
    con = duck(sf)
    bad = 0
    for n in names:
        diffs = type_diffs(QUERIES[n](spark, sf), con, ORACLE[n])
        if diffs:
            bad += 1
            print(f"DIFF {n}: {diffs}", flush=True)
    print(f"{len(names) - bad}/{len(names)} types equal")


if __name__ == "__main__":
    main(sys.argv)
