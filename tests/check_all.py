"""CLI: run queries() against oracle_sql() at one scale and print a table.

python tests/check_all.py [sf_dir] [key-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from framewise.session import build_session  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    if os.environ.get("FRAMEWISE_VANILLA"):
        # a session as a caller might build it: defaults, given time zone
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", os.environ["FRAMEWISE_VANILLA"])
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    con = duck(sf)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if prefixes and not any(k.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if k in orc:
                ok, msg = compare(df, con, orc[k])
            else:
                n = df.count()
                ok, msg = True, f"rows-only {n}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc(limit=2)
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:32s} {time.time()-t0:6.2f}s {msg}", flush=True)
    print(f"{len(qs)} keys, {len(orc)} with oracle, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
