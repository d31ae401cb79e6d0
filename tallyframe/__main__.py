"""Command line: ``python -m tallyframe publish|validate|report ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import reports
from tallyframe.plans.publish import publish_file
from tallyframe.plans.validation import validate
from tallyframe.sources import tables


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyframe")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("publish", "validate", "report"):
        command = commands.add_parser(name)
        command.add_argument("namespace", help="schema or catalog.schema")
        command.add_argument("--root", help="shared folder of the tables")
        if name == "report":
            continue
        command.add_argument("path", help="CSV file or folder")
        command.add_argument("--max-reject-rate", type=float, default=0.01)
        command.add_argument("--threshold-pp", type=float, default=1.0)
        if name == "publish":
            command.add_argument("--expected-sha256")
        else:
            command.add_argument("--evidence", help="new folder for the exported results")
    return parser.parse_args(given)


def report(spark: SparkSession, namespace: str) -> None:
    def view(name: str):
        return spark.table(f"{namespace}.{name}")

    for rows in (
        reports.monthly_trend(view("gold_monthly")),
        reports.latest_month_concentration(view("gold_segments"), view("gold_monthly")),
        reports.review_alerts(view("gold_alerts")),
        reports.run_status(view("pipeline_runs")),
        reports.rejection_triage(view("quarantine_records")).orderBy("run_id", F.desc("rejected_rows"), "rejection_reason"),
    ):
        # grouped or limited by definition, so it is printed whole
        rows.show(max(1, rows.count()), False)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = SparkSession.builder.appName("tallyframe").getOrCreate()
    if args.command == "report":
        tables.install(spark, args.namespace, root=args.root)
        report(spark, args.namespace)
        return
    options = {
        "max_reject_rate": args.max_reject_rate,
        "threshold_pp": args.threshold_pp,
        "root": args.root,
    }
    if args.command == "publish":
        run = publish_file(spark, args.path, args.namespace, args.expected_sha256, **options)
    else:
        run = validate(spark, args.path, args.namespace, args.evidence, **options)
    print(json.dumps(run, indent=2))


if __name__ == "__main__":
    main()
