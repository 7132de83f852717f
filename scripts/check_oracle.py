"""Run every registered query and compare with its SQL twin.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import ORACLE, QUERIES  # noqa: E402
from eventide.plans.compare import compare, duck  # noqa: E402
from eventide.session import get_spark  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    tz = os.environ.get("CHECK_TZ")  # e.g. America/Los_Angeles: results must not depend on it
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra_conf={"spark.sql.session.timeZone": tz} if tz else None)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf_dir)
            if n in ORACLE:
                ok, msg = compare(df, con, ORACLE[n])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, "".join(traceback.format_exception_only(type(e), e))[:1500]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
