"""Command line: compare every registered query (or the named ones) with its oracle.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import build_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        if name not in sqls:
            n = qs[name](spark, sf).count()
            print(f"{name:28s} rows-only {n} ({time.time() - t0:.1f}s)")
            continue
        try:
            problems, ns, nd = compare(spark, con, name, qs[name], sqls[name], sf)
        except Exception as e:  # report and continue
            problems, ns, nd = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, -1
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:28s} spark={ns} duck={nd} ({time.time() - t0:.1f}s) "
              f"{'; '.join(problems)}", flush=True)
    print(f"{bad} mismatches")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
