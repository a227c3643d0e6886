"""python -m gridfold.cli: plans, inventories and verification from the shell."""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from gridfold import sinks
from gridfold.plans import calendar
from gridfold.release import Release


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="gridfold")
    commands = parser.add_subparsers(dest="command", required=True)
    plan = commands.add_parser("plan-backfill", help="every day and asset of a period")
    plan.add_argument("start", type=date.fromisoformat)
    plan.add_argument("end", type=date.fromisoformat)
    plan.add_argument("--group-prefix", default="release-")
    hours = commands.add_parser("inventory", help="the hourly objects that cover a time range")
    hours.add_argument("start_ns", type=int)
    hours.add_argument("end_ns", type=int)
    hours.add_argument("--prefix", default="")
    partition = commands.add_parser("verify-partition", help="a partition's tables against its manifest")
    partition.add_argument("path")
    release = commands.add_parser("verify-release", help="the files of a release, each read again and held against its name")
    release.add_argument("path")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("gridfold").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "verify-release":
        root, _, tag = args.path.rstrip("/").rpartition("/")
        wrong = 0
        for row in Release(spark, root, tag).verified().orderBy("name").toLocalIterator():
            print(json.dumps(row.asDict(), sort_keys=True))
            wrong += row["state"] != "uploaded"
        return int(wrong > 0)
    if args.command == "plan-backfill":
        rows = calendar.backfill_plan(spark, args.start, args.end, args.group_prefix).orderBy("day", "asset")
    elif args.command == "inventory":
        rows = calendar.source_hours(spark, args.start_ns, args.end_ns, args.prefix).orderBy("hour_s")
    else:
        for name, table in sinks.verify_partition(spark, args.path)["tables"].items():
            print(name, table["rows"], "ok")
        return 0
    for row in rows.toLocalIterator():
        print(json.dumps(row.asDict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
