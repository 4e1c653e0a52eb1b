"""Command line: ``python -m tagledger --bronze … --silver … --source … --run-date … --run-hour …``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tagledger.plans.slot import Paths, run_slot
from tagledger.schemas import Slot


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tagledger", description="Run one slot.")
    for name in ("bronze", "silver", "source"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--database", default="default")
    parser.add_argument("--run-date", help="YYYY-MM-DD, UTC; the present hour if left out")
    parser.add_argument("--run-hour", help="HH, UTC")
    parser.add_argument("--layout", choices=("auto", "array", "lines"), default="auto")
    parser.add_argument("--staging-as", choices=("view", "table"), default="view")
    args = parser.parse_args(argv)
    if (args.run_date is None) != (args.run_hour is None):
        parser.error("give both --run-date and --run-hour, or none")
    slot = Slot.parse(args.run_date, args.run_hour) if args.run_date else Slot.current()
    spark = SparkSession.builder.appName("tagledger").getOrCreate()
    paths = Paths(args.bronze, args.silver, args.source, args.database)
    report = run_slot(spark, paths, slot, args.layout, staging_as=args.staging_as)
    if not report.loaded:
        print(f"no files for {slot.folder}")
        return 0
    print(f"{slot.folder}: {report.metrics}, off-slot rows: {report.off_slot_rows}")
    for p in report.partitions:
        print(f"partition {p.category}/{p.run_date}/{p.run_hour}: {'ok' if p.registered else p.message}")
    for c in report.checks:
        print(f"{'pass' if c['passed'] else 'FAIL'} {c['test']} {c['table']}.{c['column']}: {c['failures']}")
    return 0 if report.passed else 1


if __name__ == "__main__":
    sys.exit(main())
