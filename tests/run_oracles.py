"""Run registered queries against their oracle SQL: python -m tests.run_oracles [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

from segmetric.session import get_spark
from tests.oracle_harness import compare, duck_connect


def main() -> int:
    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("oracle-check")
    qs, sql = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                ok, msg = compare(df, sql[name], sf_dir, con, digits=int(os.environ.get("ORACLE_DIGITS", "5")))
            else:
                ok, msg = True, f"rows-only {df.count()} rows"
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
