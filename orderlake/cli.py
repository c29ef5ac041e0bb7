"""spark-submit entry point: one daily run, the DDL, or a report.

    spark-submit --py-files orderlake.zip orderlake/cli.py run --source-csv s3://.../sales/ --log s3://.../events/ \\
        --lake s3://.../lake --warehouse s3://.../gold --run-id 2026-12-03
    spark-submit --py-files orderlake.zip orderlake/cli.py declare --database sales_dwh --warehouse s3://.../gold
    spark-submit --py-files orderlake.zip orderlake/cli.py report revenue_by_region --warehouse s3://.../gold

The session (master, executors, spark.checkpoint.dir) comes from spark-submit;
a scheduler calls ``run`` once per period with a run id and may retry it freely.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from orderlake.plans.daily_run import RunConfig, daily_run
from orderlake.plans.ddl import declare_gold
from orderlake.plans.publish import Warehouse
from orderlake.plans.published_reports import REPORTS
from orderlake.sources.csv import read_sales_csv
from orderlake.sources.eventlog import EventLog

def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="orderlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="produce -> ingest -> gold -> gate -> publish")
    run.add_argument("--run-id", required=True)
    run.add_argument("--log", required=True, help="event log folder (JSON lines)")
    run.add_argument("--lake", required=True, help="bronze, quarantine, checkpoints, control")
    run.add_argument("--warehouse", required=True, help="published gold tables")
    run.add_argument("--database", default=None, help="re-point declared tables in this database")
    run.add_argument("--source-csv", default=None, help="send this CSV's rows to the log first")
    run.add_argument("--slice-rows", type=int, default=None, help="rows sent per run (default: all)")
    run.add_argument("--max-per-trigger", type=int, default=None)
    run.add_argument("--max-records", type=int, default=None, help="records ingested per run, exactly")
    decl = sub.add_parser("declare", help="create the database and the six declared tables")
    decl.add_argument("--database", required=True)
    decl.add_argument("--warehouse", required=True)
    rep = sub.add_parser("report", help="print a report over the published tables")
    rep.add_argument("name", choices=sorted(REPORTS))
    rep.add_argument("--warehouse", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"orderlake-{args.cmd}").getOrCreate()
    if args.cmd == "declare":
        declare_gold(spark, args.database, args.warehouse)
    elif args.cmd == "run":
        cfg = RunConfig(EventLog("files", path=args.log), args.lake, Warehouse(args.warehouse, args.database),
                        slice_rows=args.slice_rows, max_per_trigger=args.max_per_trigger,
                        max_records=args.max_records)
        source = read_sales_csv(spark, args.source_csv, keep_corrupt=True) if args.source_csv else None
        report = daily_run(spark, cfg, args.run_id, source=source)
        print(json.dumps({"run_id": report.run_id, "sent": report.sent, "rows": report.rows}))
    else:
        report = REPORTS[args.name](spark, Warehouse(args.warehouse))
        print("\t".join(report.columns))
        for row in report.toLocalIterator():  # every row, a partition at a time
            print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()
