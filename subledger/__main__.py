"""Command line: build all layers, or run the data-quality tests.

    python -m subledger build --bronze <parquet root | csv root> [--csv] --out <root>
                              [--as-of YYYY-MM-DD] [--run-ts 'YYYY-MM-DD HH:MM:SS'] [--multi-line]
    python -m subledger test  --out <out root>

``build`` is the scheduled run (silver, quarantine with incremental upsert,
gold, DQ reports); its exit status is 2 if a test of severity ``error`` kept it from
being published; ``test`` prints the not_null / unique report of a build.
The session comes from ``spark-submit`` (master, checkpoint dir, resources).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def _params(args):
    """Run parameters; what the flags leave open comes from the clock, asked once, in UTC."""
    from subledger.params import RunParams

    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else now.date()
    run_ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else now
    return RunParams(as_of=as_of, run_ts=run_ts)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="subledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--bronze", required=True)
    b.add_argument("--csv", action="store_true", help="bronze root holds <table>/ CSV folders")
    b.add_argument("--multi-line", action="store_true", help="quoted CSV fields may hold line breaks")
    b.add_argument("--out", required=True)
    b.add_argument("--as-of")
    b.add_argument("--run-ts")
    t = sub.add_parser("test")
    t.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from subledger.session import BASE_CONF

    builder = SparkSession.builder.appName(f"subledger-{args.cmd}")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()

    if args.cmd == "build":
        from subledger.plans.pipeline import AuditFailed, build
        from subledger.sources.bronze import TABLES, Bronze, load_csv, read_bronze

        if args.csv:
            bronze = Bronze(**{
                t: load_csv(spark, f"{args.bronze}/{t}", t, f"{args.out}/bronze/{t}", args.multi_line) for t in TABLES
            })
        else:
            bronze = read_bronze(spark, args.bronze)
        try:
            res = build(spark, bronze, args.out, _params(args))
        except AuditFailed as e:
            print(f"not published: {e}", file=sys.stderr)
            return 2
        for name, path in res.tables.items():
            print(f"{name}\t{path}")
        return 0

    from subledger.plans.pipeline import read_table

    not_null, unique = (read_table(spark, args.out, f"dq_{n}") for n in ("not_null", "unique"))
    report = not_null.unionByName(unique)
    rows = report.orderBy("model", "column_name", "test_name").collect()  # one row per declared test
    for r in rows:
        print(f"{r.status.upper():5s} {r.test_name:9s} {r.model}.{r.column_name} failures={r.failures}")
    return 1 if any(r.status == "fail" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
