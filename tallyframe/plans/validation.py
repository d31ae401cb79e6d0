"""End-to-end rehearsal on a real snapshot: publish, replay, refuse, reconcile, export."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyframe.contract import CARD, Contract
from tallyframe.operators import checks, gate, quality, reports
from tallyframe.plans.publish import COUNTED, integrity_report, publish, publish_file
from tallyframe.sources import tables
from tallyframe.sources.export import write_csv, write_json
from tallyframe.sources.snapshot import read_snapshot

# Sort order of the exported views.
EXPORTS = {
    "gold_monthly": ("month",),
    "gold_segments": ("month", "limit_band"),
    "gold_alerts": ("month",),
}


def validate(
    spark: SparkSession,
    path: str,
    namespace: str,
    evidence: str | None = None,
    contract: Contract = CARD,
    **options,
) -> dict:
    """Run records of a publication and its replay, and what was checked about them.

    ``evidence`` names a new folder for the gold views as CSV and the run log as
    JSON. ``options`` go to ``publish``.
    """
    runs = [publish_file(spark, path, namespace, contract=contract, **options) for _ in range(2)]
    audit = spark.table(f"{namespace}.{tables.RUNS}")
    latest = audit.where(F.col("run_id") == runs[-1]["run_id"]).first()

    # no row of this batch has an id, so none can be accepted
    raw = read_snapshot(spark, path, contract)
    reason = None
    try:
        publish(spark, raw.withColumn(contract.id, F.lit(None).cast("string")), namespace, contract=contract, **options)
    except ValueError as problem:
        reason = str(problem)

    bronze = spark.table(f"{namespace}.{tables.BRONZE}").where(F.col("source_sha256") == latest.source_sha256)
    accepted = quality.accepted_rows(quality.check_rows(raw, contract), contract)
    differences = checks.reconcile(
        spark.table(f"{namespace}.gold_monthly"), checks.monthly_from_wide(accepted, contract)
    )
    visible = reports.latest_success(audit).first()
    found = {
        "replay_adds_no_bronze_rows": bronze.count() == latest.raw_rows - latest.exact_duplicates,
        "replay_has_the_same_counts": len({tuple(run[c] for c in COUNTED) for run in runs}) == 1,
        "spoiled_batch_is_refused": reason == gate.NO_ROWS,
        "previous_run_stays_visible": visible.run_id == latest.run_id
        and spark.table(f"{namespace}.silver_accounts").where(F.col("run_id") != latest.run_id).isEmpty(),
        "integrity_checks_pass": integrity_report(spark, namespace).where("NOT passed").isEmpty(),
        "monthly_metrics_reconcile": differences.isEmpty(),
    }
    if evidence:
        for view, order in EXPORTS.items():
            write_csv(spark.table(f"{namespace}.{view}").orderBy(*order), f"{evidence}/{view}")
        write_json(spark.table(f"{namespace}.pipeline_runs").orderBy("completed_at"),
                   f"{evidence}/pipeline_runs")
    return {"first_run": runs[0], "replay_run": runs[1], "checks": found}
