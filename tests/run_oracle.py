"""Command line: python tests/run_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

from verdant.plans import ORACLE, QUERIES  # noqa: E402
from verdant.session import build_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    data_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or sorted(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(data_dir)
    bad = 0
    for n in names:
        t = time.time()
        if n not in ORACLE:
            rows = QUERIES[n](spark, data_dir).count()
            print(f"{n:28s} NO-ORACLE rows={rows} {time.time()-t:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLE[n], data_dir)
        except Exception as e:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:600]}",
                 "spark_rows": "?", "duck_rows": "?"}
        bad += not r["ok"]
        status = "OK " if r["ok"] else "BAD"
        print(f"{n:28s} {status} rows={r['spark_rows']}/{r['duck_rows']} {time.time()-t:.1f}s"
              + ("" if r["ok"] else f"\n    {r['error']}"), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
