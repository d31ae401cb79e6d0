"""The analyst reports, over published views or any frames of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.contract import CARD, Contract

# The run that readers see: the latest SUCCESS, ties broken by run id; NULL without one.
NEWEST_SUCCESS = "max_by(struct(*), struct(completed_at, run_id)) FILTER (WHERE status = 'SUCCESS')"


def monthly_trend(gold_monthly: DataFrame, contract: Contract = CARD) -> DataFrame:
    return gold_monthly.select(
        "month", "accounts", "delayed_accounts", "delayed_account_rate",
        contract.money("positive_bill"), contract.money("delayed_bill"),
        "delayed_bill_share", "undocumented_status_accounts",
    ).orderBy("month")


def latest_month_concentration(
    gold_segments: DataFrame, gold_monthly: DataFrame, contract: Contract = CARD
) -> DataFrame:
    """Bands of the latest month, worst rate first.

    The month is a scalar subquery, so Spark filters the facts before it
    aggregates them, and prunes all other months where they are partitions.
    """
    latest = gold_monthly.agg(F.max("month")).scalar()
    return (
        gold_segments.where(F.col("month") == latest)
        .select("limit_band", "accounts", "delayed_accounts", "delayed_account_rate",
                contract.money("positive_bill"))
        .orderBy(F.desc("delayed_account_rate"))
    )


def review_alerts(gold_alerts: DataFrame) -> DataFrame:
    return gold_alerts.where(F.col("alert_status") == "REVIEW").orderBy("month")


def recent_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    """Newest runs first; equal times are ordered by run id, newest id first."""
    return runs.orderBy(F.desc("completed_at"), F.desc("run_id")).limit(limit)


def run_status(runs: DataFrame, limit: int = 20) -> DataFrame:
    """What the newest runs took in and gave out; the same order as recent_runs."""
    return recent_runs(runs, limit).select(
        "run_id", "completed_at", "status", "raw_rows", "exact_duplicates", "rejected_rows",
        "accepted_accounts", "monthly_rows", "message",
    )


def latest_success(runs: DataFrame) -> DataFrame:
    """The run that readers see: newest SUCCESS, ties broken by run id."""
    return runs.agg(F.expr(NEWEST_SUCCESS).alias("run")).where("run IS NOT NULL").select("run.*")


def rejection_triage(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("run_id", "rejection_reason").agg(
        F.count(F.lit(1)).alias("rejected_rows")
    )


def rejected_sample(quarantine: DataFrame, run_id: str, contract: Contract = CARD, rows: int = 20) -> DataFrame:
    """For a first look, of each reason the rejected rows of a run with the least row hashes.

    A hash is as good as a draw, but the same rows come back however the table is
    stored or read, and samples of parts merge into that of the whole: each task
    keeps the least hashes of a reason before anything is shuffled.
    """
    found = quarantine.where(F.col("run_id") == run_id).select(contract.id, "rejection_reason", "record_hash")
    rank = F.row_number().over(Window.partitionBy("rejection_reason").orderBy("record_hash"))
    return found.withColumn("rank", rank).where(F.col("rank") <= rows).select("rejection_reason", "rank", contract.id, "record_hash")
