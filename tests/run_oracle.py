"""CLI: run every (or the named) registered query against its oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402
from tickline.session import build_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session(master="local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name not in oracle:
                print(f"{name:24s} rows={df.count()} (no oracle)")
                continue
            r = compare(df, con, oracle[name])
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"{name:24s} ERROR {type(exc).__name__}: {str(exc)[:600]}")
            continue
        ok = r.get("columns_match") and r.get("types_match") and r.get("values_match") and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} {time.time() - t:5.1f}s {r}")
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
