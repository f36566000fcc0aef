"""Command line: ``spark-submit -m marquee <job> ...`` or ``python -m marquee <job> ...``.

Jobs:
  warehouse  --metrics GLOB --catalogue GLOB --out DIR [--buckets N] [--partition-by-month]
             [--publish]
  legacy     --catalogue GLOB --out DIR [--metrics GLOB] [--history DIR] [--users FILE]
             [--as-of "March 2025"] [--collation UNICODE_CI_AI] [--declare]
  incremental --source DIR --target DIR --checkpoint DIR --keys k1,k2 --order c1,c2
             --schema "k bigint, ts timestamp_ntz, ..." [--format parquet]

The session comes from the launcher (master, memory, spark.checkpoint.dir);
nothing here sets a master.
"""

from __future__ import annotations

import argparse
import sys

from .session import build_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="job", required=True)
    w = sub.add_parser("warehouse")
    w.add_argument("--metrics", required=True)
    w.add_argument("--catalogue", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--buckets", type=int)
    w.add_argument("--partition-by-month", action="store_true")
    w.add_argument("--publish", action="store_true")
    lg = sub.add_parser("legacy")
    lg.add_argument("--catalogue", required=True)
    lg.add_argument("--out", required=True)
    lg.add_argument("--metrics")
    lg.add_argument("--history")
    lg.add_argument("--users")
    lg.add_argument("--as-of")
    lg.add_argument("--collation")
    lg.add_argument("--declare", action="store_true")
    inc = sub.add_parser("incremental")
    for a in ("--source", "--target", "--checkpoint", "--keys", "--order", "--schema"):
        inc.add_argument(a, required=True)
    inc.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.job == "warehouse":
        from .plans import pipeline
        _, summary = pipeline.run(spark, args.metrics, args.catalogue, args.out,
                                  buckets=args.buckets,
                                  partition_fact_by_month=args.partition_by_month,
                                  publish=args.publish)
        for row in summary:
            print("\t".join(map(str, row)))
    elif args.job == "legacy":
        from .plans import legacy
        tables = legacy.run(spark, args.out, args.catalogue, args.metrics, args.history,
                            args.users, players_as_of=args.as_of, collation=args.collation,
                            declare=args.declare)
        for name in sorted(tables):
            if name.endswith("_audit"):
                tables[name].where("file_path IS NULL").show(truncate=False)
    else:
        from pyspark.sql.types import _parse_datatype_string

        from .streaming.incremental import run_incremental
        run_incremental(spark, args.source, _parse_datatype_string(args.schema), args.target,
                        args.checkpoint, args.keys.split(","), args.order.split(","),
                        fmt=args.format)
    return 0


if __name__ == "__main__":
    sys.exit(main())
